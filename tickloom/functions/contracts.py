"""Record contracts: declared fields, their types and value rules.

A record violates a contract at most once per field, in declaration order: the field is missing,
or not of its type, or breaks the first of its rules that applies.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas

Typed = dict[str, Column]


@dataclass(frozen=True)
class Rule:
    message: str
    broken: Callable[[Typed], Column]


@dataclass(frozen=True)
class Contract:
    topic: str
    schema: T.StructType
    rules: dict[str, tuple[Rule, ...]] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _positive(name: str) -> Rule:
    # NaN <= 0 is false, so NaN passes.
    return Rule(f"{name} must be positive", lambda typed: typed[name] <= 0)


def _known_symbol(symbols: tuple[str, ...]) -> Rule:
    return Rule("unknown symbol", lambda typed: ~typed["symbol"].isin(*symbols))


def _recent(floor_ms: int) -> Rule:
    return Rule("timestamp is too old", lambda typed: typed["timestamp"] < floor_ms)


def _ask_not_above_bid(typed: Typed) -> Column:
    """Only judged against a valid bid. Spark orders NaN highest, hence the explicit tests."""
    ask, bid = typed["top_ask_price"], typed["top_bid_price"]
    return bid.isNotNull() & (bid > 0) & ~F.isnan(bid) & ~F.isnan(ask) & (ask <= bid)


def trade_contract(symbols: tuple[str, ...] = schemas.SYMBOLS) -> Contract:
    return Contract(schemas.TRADE_TOPIC, schemas.TRADE, {
        "symbol": (_known_symbol(symbols),),
        "price": (_positive("price"),),
        "size": (_positive("size"),),
        "timestamp": (_recent(schemas.MIN_TIMESTAMP_MS),),
    })


def book_contract(symbols: tuple[str, ...] = schemas.SYMBOLS) -> Contract:
    return Contract(schemas.BOOK_TOPIC, schemas.BOOK, {
        "symbol": (_known_symbol(symbols),),
        "timestamp": (_recent(schemas.MIN_TIMESTAMP_MS),),
        "top_bid_price": (_positive("top_bid_price"),),
        "top_ask_price": (
            _positive("top_ask_price"),
            Rule("ask must be greater than bid", _ask_not_above_bid),
        ),
        "total_bid_volume": (_positive("total_bid_volume"),),
        "total_ask_volume": (_positive("total_ask_volume"),),
        "bid_ask_ratio": (_positive("bid_ask_ratio"),),
    })


def contract_for(topic: str) -> Contract | None:
    """Contract of a topic; dead-letter and unknown topics have none."""
    return {
        schemas.TRADE_TOPIC: trade_contract(),
        schemas.BOOK_TOPIC: book_contract(),
    }.get(topic)
