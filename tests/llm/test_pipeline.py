import re

import pytest
from conftest import SF_DIR

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from llm.test_linededup import expected as kept_lines  # noqa: E402
from llm.test_mixing import wanted_targets  # noqa: E402
from llm.test_simhash import components, slow_fingerprint  # noqa: E402

from tickloom.llm import quality  # noqa: E402
from tickloom.llm.common import documents, materialize  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_each_stage_does_what_brute_force_does(spark):
    docs, tables = documents(spark, SF_DIR), []
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF_DIR), "stage")
        tables.append(docs)
    good, lines, single, mixed, packed = tables
    assert all(t.columns == documents(spark, SF_DIR).columns for t in tables[:-1])
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    predicted = quality.classify(documents(spark, SF_DIR), labels).where("predicted = 1").collect()
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in predicted)
    assert sorted((r.doc_id, r.text) for r in lines.collect()) == \
        [x[:2] for x in sorted(kept_lines([(r.doc_id, r.text) for r in good.collect()]))]
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in lines.collect()]
    label = components({fp: min(i for i, f in rows if f == fp) for _, fp in rows})
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(label.values()))
    words = {}
    for r in single.collect():
        words[r.source] = words.get(r.source, 0) + len(WORD.findall(r.text))
    taken = {}
    for r in mixed.collect():
        taken[r.source] = taken.get(r.source, 0) + len(WORD.findall(r.text))
    for source, target in wanted_targets(words).items():
        assert abs(taken.get(source, 0) - target) <= 2
    rows = mixed.collect()
    assert packed.where("piece = 0").count() == len(rows)
    assert corpus_pipeline.run(spark, SF_DIR).count() == packed.count()


def test_stages_take_empty_and_odd_tables(spark, edge_docs, no_docs):
    for docs in (no_docs, edge_docs):
        for _, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, SF_DIR)
            assert found.columns[0] == "doc_id" and found.count() >= 0
