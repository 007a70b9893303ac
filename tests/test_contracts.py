import json
import math

import pytest
from pyspark.sql import functions as F

from tickloom.functions.contracts import book_contract, contract_for, trade_contract
from tickloom.operators.contract import check, check_json, dead_letters, valid_records
from tickloom.schemas import BOOK, TRADE

NOW = 1_704_067_200_000


def trade(symbol="BTCUSDT", price=100.0, size=1.0, timestamp=NOW, trade_id=1):
    return (symbol, price, size, timestamp, trade_id)


def book(bid=10.0, ask=11.0, symbol="BTCUSDT", timestamp=NOW, bid_volume=5.0, ask_volume=5.0,
         ratio=1.0):
    depth = [[10.0, 1.0]]
    return (symbol, timestamp, bid, 1.0, ask, 1.0, depth, depth, bid_volume, ask_volume, ratio)


def fields(df):
    return [[v["field"] for v in row["violations"]] for row in df.select("violations").collect()]


@pytest.mark.parametrize("row, expected", [
    (trade(symbol="XYZUSDT"), ["symbol"]),
    (trade(price=-50.0), ["price"]),
    (trade(timestamp=999), ["timestamp"]),
    (trade(timestamp=1_577_836_800_000), []),
    (trade(symbol="NOPE", price=0.0, size=-1.0), ["symbol", "price", "size"]),
    (trade(price=math.nan), []),
    (trade(trade_id=None), ["trade_id"]),
])
def test_trade_rules(spark, row, expected):
    checked = check(spark.createDataFrame([row], TRADE), trade_contract())
    assert fields(checked) == [expected]
    assert checked.first()["valid"] == (not expected)


@pytest.mark.parametrize("row, expected", [
    (book(), []),
    (book(bid=10.0, ask=10.0), [("top_ask_price", "ask must be greater than bid")]),
    (book(bid=-1.0, ask=-2.0), [("top_bid_price", "top_bid_price must be positive"),
                                ("top_ask_price", "top_ask_price must be positive")]),
    (book(bid=-1.0, ask=5.0), [("top_bid_price", "top_bid_price must be positive")]),
    (book(bid=math.nan, ask=5.0), []),
    (book(bid=5.0, ask=math.nan), []),
    (book(bid=math.nan, ask=math.nan), []),
    (book(bid_volume=0.0, ask_volume=-1.0, ratio=0.0), [
        ("total_bid_volume", "total_bid_volume must be positive"),
        ("total_ask_volume", "total_ask_volume must be positive"),
        ("bid_ask_ratio", "bid_ask_ratio must be positive")]),
])
def test_book_rules(spark, row, expected):
    checked = check(spark.createDataFrame([row], BOOK), book_contract()).first()
    assert [(v["field"], v["message"]) for v in checked["violations"]] == expected
    assert checked["valid"] == (not expected)


def test_json_records_are_coerced_for_publishing_and_kept_as_received(spark):
    received = json.dumps({"symbol": "BTCUSDT", "price": "100.5", "size": 1, "timestamp": NOW,
                           "trade_id": 7, "venue": "x"})
    checked = check_json(spark.createDataFrame([(received,)], "value string"), trade_contract())
    assert checked.first()["raw"] == received
    published = valid_records(checked)
    assert published.columns == TRADE.fieldNames()
    assert published.first()["price"] == 100.5


@pytest.mark.parametrize("text, expected", [
    ("{broken", ["record"]),
    ("[1, 2]", ["record"]),
    ("{}", ["symbol", "price", "size", "timestamp", "trade_id"]),
    ('{"symbol":"BTCUSDT","price":"1.5d","size":"x","timestamp":1.5,"trade_id":"12.0"}',
     ["price", "size", "timestamp"]),
])
def test_json_type_errors(spark, text, expected):
    checked = check_json(spark.createDataFrame([(text,)], "value string"), trade_contract())
    assert fields(checked) == [expected]


def test_json_books_read_nested_depth(spark):
    record = dict(zip(BOOK.fieldNames(), book()))
    df = spark.createDataFrame([(json.dumps(record),)], "value string")
    row = valid_records(check_json(df, book_contract())).first()
    assert row["bid_depth"] == [[10.0, 1.0]] and row["total_bid_volume"] == 5.0


def test_dead_letter_envelope(spark):
    df = spark.createDataFrame([trade(symbol="NOPE", price=0.0)], TRADE)
    letter = dead_letters(check(df, trade_contract()), "crypto-prices-dlq", F.lit("now")).first()
    assert letter["error"] == "symbol: unknown symbol; price: price must be positive"
    assert json.loads(letter["raw"])["symbol"] == "NOPE"
    assert (letter["topic"], letter["timestamp"]) == ("crypto-prices-dlq", "now")


def test_dead_letter_topics_have_no_contract():
    assert contract_for("crypto-prices-dlq") is None
