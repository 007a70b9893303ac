import json

import pytest

from tickloom.operators.parse import parse_depth, parse_trades


def trade_message(**changes):
    data = {"e": "trade", "s": "BTCUSDT", "p": "1.5", "q": "2", "T": 1704067200000, "t": 9}
    data.update(changes)
    return json.dumps({"data": {k: v for k, v in data.items() if v is not ...}})


@pytest.mark.parametrize("text, status", [
    (trade_message(), "ok"),
    (trade_message(e="aggTrade"), "not_trade"),
    ('{"x": 1}', "not_trade"),
    (trade_message(p=...), "unparseable"),
    (trade_message(q="abc"), "unparseable"),
    (trade_message(p="1.5d"), "unparseable"),
    ("{broken", "unparseable"),
    ("[]", "unparseable"),
])
def test_trade_status(spark, text, status):
    row = parse_trades(spark.createDataFrame([(text,)], "value string")).first()
    assert row["parse_status"] == status


def test_trade_fields_tell_case_apart(spark):
    row = parse_trades(spark.createDataFrame([(trade_message(),)], "value string")).first()
    assert (row["timestamp"], row["trade_id"], row["price"], row["size"]) == (
        1704067200000, 9, 1.5, 2.0)


def depth(bids, asks, stream="btcusdt@depth20@1000ms"):
    return json.dumps({"stream": stream, "data": {"bids": bids, "asks": asks}})


@pytest.mark.parametrize("text, status", [
    (depth([["10", "1"]], [["11", "2"]]), "ok"),
    (depth([["10", "1"]], []), "empty_book"),
    (json.dumps({"stream": "x", "data": {"bids": [["1", "2"]]}}), "empty_book"),
    (depth([["10", "1"]], [["11", "0"]]), "unparseable"),
    (depth([["10", "1"], ["9"]], [["11", "2"]]), "unparseable"),
    (depth([["10", "1"]], [["11", "2", "3"]]), "unparseable"),
    (depth([["10", "x"]], [["11", "2"]]), "unparseable"),
    (depth([["10", "1f"]], [["11", "2"]]), "unparseable"),
    ("nope", "unparseable"),
])
def test_depth_status(spark, text, status):
    df = spark.createDataFrame([(text, 5)], "value string, ingest_ts long")
    assert parse_depth(df).first()["parse_status"] == status


def test_depth_values(spark):
    text = depth([["10", "1"], ["9.5", "3"]], [["11", "2"], ["12", "6"]])
    row = parse_depth(spark.createDataFrame([(text, 5)], "value string, ingest_ts long")).first()
    assert row["symbol"] == "BTCUSDT" and row["timestamp"] == 5
    assert (row["top_bid_price"], row["top_ask_qty"]) == (10.0, 2.0)
    assert (row["total_bid_volume"], row["total_ask_volume"]) == (4.0, 8.0)
    assert row["bid_ask_ratio"] == 0.5
    assert row["ask_depth"] == [[11.0, 2.0], [12.0, 6.0]]
