"""What the planner does with the operators whose plans matter."""

from pyspark.sql import functions as F

from tickloom.operators.joins import asof_join
from tickloom.operators.views import live_board
from tickloom.plans import market
from tickloom.operators.evaluate import prediction_records
from tickloom.session import materialize


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_carried_books_need_no_sort_aggregate_over_all_events(spark, sf_dir, monkeypatch):
    from tickloom.operators import ordered

    plans = []

    def spying(df, name):
        plans.append((name, plan_of(df)))
        return materialize(df, name)

    monkeypatch.setattr(ordered, "materialize", spying)
    asof_join(market.valid_trades(spark, sf_dir), market.valid_books(spark, sf_dir)).count()
    assert "SortAggregate" not in dict(plans)["last-values"]


def test_live_board_takes_the_newest_prediction_without_a_sort_aggregate(spark, sf_dir):
    trades = materialize(market.valid_trades(spark, sf_dir), "trades")
    predictions = prediction_records(market.derived_predictions(trades), F.col("timestamp"))
    assert "SortAggregate" not in plan_of(live_board(trades, predictions))
