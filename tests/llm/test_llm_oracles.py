import oracle
import pytest
from conftest import SF_DIR

from tickloom.llm.oracles import llm_oracles
from tickloom.llm.queries import llm_queries


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_matches_sql(spark, duck, name):
    assert oracle.compare(llm_queries()[name](spark, SF_DIR), duck, llm_oracles()[name]) is None


def test_there_is_a_query_for_each_operator():
    assert [name.split("_")[0] for name in llm_queries()] == [f"op{n}" for n in range(1, 14)]
