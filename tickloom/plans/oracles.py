"""The same queries as SQL for DuckDB, written from the rules and not from the Spark code."""

from tickloom.schemas import FEATURE_COLS

_CTES = {
    "base": """
        select event_id, event_type, value, ts,
               cast(json_extract_string(props, '$.k') as bigint) as k,
               ['BTCUSDT','ETHUSDT','SOLUSDT','XYZUSDT']
                 [case when user_id % 20 = 19 then 4 else user_id % 3 + 1 end] as symbol,
               1704067200000 + event_id * 400 as ts_ms
        from events""",
    "trades": """
        select symbol, value as price, (k + 1) / 10.0::double as size, ts_ms as "timestamp",
               event_id as trade_id
        from base where event_type not in ('purchase', 'signup')""",
    "books": """
        select symbol, ts_ms as "timestamp", value as top_bid_price,
               (k + 1) * 20.0::double / 20.0::double as top_bid_qty,
               value + (k - 5) / 100.0::double as top_ask_price,
               ((k * 7) % 100 + 1) * 20.0::double / 20.0::double as top_ask_qty,
               (k + 1) * 20.0::double as total_bid_volume,
               ((k * 7) % 100 + 1) * 20.0::double as total_ask_volume,
               ((k + 1) * 20.0::double) / (((k * 7) % 100 + 1) * 20.0::double) as bid_ask_ratio
        from base where event_type in ('purchase', 'signup')""",
    "vtrades": """
        select * from trades
        where symbol in ('BTCUSDT','ETHUSDT','SOLUSDT') and price > 0 and size > 0""",
    "vbooks": """
        select * from books
        where symbol in ('BTCUSDT','ETHUSDT','SOLUSDT') and top_bid_price > 0
          and top_ask_price > top_bid_price""",
    "spoiled_trades": """
        select symbol,
               case when trade_id % 53 = 7 then -price else price end as price,
               case when trade_id % 53 in (7, 11) then 0.0 else size end as size,
               case when trade_id % 53 = 13 then 999 else "timestamp" end as "timestamp",
               case when trade_id % 53 = 17 then null else trade_id end as trade_id
        from trades""",
    "trade_faults": """
        select *,
          case when symbol not in ('BTCUSDT','ETHUSDT','SOLUSDT') then 'unknown symbol' end
            as f_symbol,
          case when price <= 0 then 'price must be positive' end as f_price,
          case when size <= 0 then 'size must be positive' end as f_size,
          case when "timestamp" < 1577836800000 then 'timestamp is too old' end as f_timestamp,
          case when trade_id is null then 'field required' end as f_trade_id
        from spoiled_trades""",
    "spoiled_books": """
        select symbol, "timestamp",
               case when ("timestamp" // 400) % 53 in (3, 5) then -1.0 else top_bid_price end
                 as top_bid_price,
               top_bid_qty,
               case when ("timestamp" // 400) % 53 = 5 then -2.0 else top_ask_price end
                 as top_ask_price,
               top_ask_qty,
               case when ("timestamp" // 400) % 53 = 11 then 0.0 else total_bid_volume end
                 as total_bid_volume,
               total_ask_volume,
               case when ("timestamp" // 400) % 53 = 11 then 0.0
                    when ("timestamp" // 400) % 53 = 17 then null
                    else bid_ask_ratio end as bid_ask_ratio
        from books""",
    "book_faults": """
        select *,
          case when symbol not in ('BTCUSDT','ETHUSDT','SOLUSDT') then 'unknown symbol' end
            as f_symbol,
          case when top_bid_price <= 0 then 'top_bid_price must be positive' end as f_bid,
          case when top_ask_price <= 0 then 'top_ask_price must be positive'
               when top_bid_price > 0 and top_ask_price <= top_bid_price
                 then 'ask must be greater than bid' end as f_ask,
          case when total_bid_volume <= 0 then 'total_bid_volume must be positive' end
            as f_bid_volume,
          case when total_ask_volume <= 0 then 'total_ask_volume must be positive' end
            as f_ask_volume,
          case when bid_ask_ratio is null then 'field required'
               when bid_ask_ratio <= 0 then 'bid_ask_ratio must be positive' end as f_ratio
        from spoiled_books""",
    "joined": """
        select t.symbol, t."timestamp", t.price, t.size, b.top_bid_price, b.top_ask_price,
               b.bid_ask_ratio, b.total_bid_volume, b.total_ask_volume, t.trade_id,
               b."timestamp" as book_timestamp,
               cast(cast(epoch_ms(t."timestamp") as date) as varchar) as date
        from vtrades t left join vbooks b
          on t.symbol = b.symbol
         and t."timestamp" // 1000 - b."timestamp" // 1000 between -1 and 1""",
    "feats": """
        select symbol, "timestamp", price, size, top_bid_price, top_ask_price,
               coalesce(bid_ask_ratio, 0.0) as bid_ask_ratio,
               coalesce(total_bid_volume, 0.0) as total_bid_volume,
               coalesce(total_ask_volume, 0.0) as total_ask_volume,
               trade_id, book_timestamp,
               lag(price, 1) over w as price_lag_1,
               lag(price, 5) over w as price_lag_5,
               lag(price, 10) over w as price_lag_10,
               price - lag(price, 1) over w as price_change,
               case when lag(price, 1) over w = 0 then 0.0
                    else (price - lag(price, 1) over w) / lag(price, 1) over w * 100 end
                 as price_change_pct,
               avg(price) over (w rows between 5 preceding and current row) as rolling_avg_5,
               avg(price) over (w rows between 10 preceding and current row) as rolling_avg_10,
               stddev_samp(price) over (w rows between 10 preceding and current row)
                 as rolling_stddev_10,
               size - lag(size, 1) over w as volume_change,
               coalesce(top_ask_price - top_bid_price, 0.0) as spread,
               case when coalesce(bid_ask_ratio, 0.0) > 1 then 'buy' else 'sell' end
                 as market_pressure
        from joined
        window w as (partition by symbol, date
                     order by "timestamp", trade_id, book_timestamp nulls first)
        qualify lag(price, 10) over w is not null""",
    "latest_book": """
        select t.symbol, t."timestamp", t.price, t.size, t.trade_id,
               b."timestamp" as book_timestamp,
               coalesce(b.top_ask_price, 0.0) - coalesce(b.top_bid_price, 0.0) as spread,
               coalesce(b.bid_ask_ratio, 0.0) as bid_ask_ratio,
               coalesce(b.total_bid_volume, 0.0) as total_bid_volume,
               coalesce(b.total_ask_volume, 0.0) as total_ask_volume
        from vtrades t asof left join vbooks b
          on t.symbol = b.symbol and t."timestamp" >= b."timestamp" """,
    "served": """
        select *,
               lag(price, 1) over w as price_lag_1,
               lag(price, 5) over w as price_lag_5,
               lag(price, 10) over w as price_lag_10,
               price - lag(price, 1) over w as price_change,
               case when lag(price, 1) over w = 0 then 0.0
                    else (price - lag(price, 1) over w) / lag(price, 1) over w * 100 end
                 as price_change_pct,
               avg(price) over (w rows between 4 preceding and current row) as rolling_avg_5,
               avg(price) over (w rows between 9 preceding and current row) as rolling_avg_10,
               stddev_pop(price) over (w rows between 9 preceding and current row)
                 as rolling_stddev_10,
               size - lag(size, 1) over w as volume_change
        from latest_book
        window w as (partition by symbol order by "timestamp", trade_id)
        qualify row_number() over w >= 11""",
    "live": """
        select *,
               lag(price, 1) over w as price_lag_1,
               lag(price, 5) over w as price_lag_5,
               lag(price, 10) over w as price_lag_10,
               price - lag(price, 1) over w as price_change,
               case when lag(price, 1) over w = 0 then 0.0
                    else (price - lag(price, 1) over w) / lag(price, 1) over w * 100 end
                 as price_change_pct,
               avg(price) over (w rows between 5 preceding and current row) as rolling_avg_5,
               avg(price) over (w rows between 10 preceding and current row) as rolling_avg_10,
               stddev_samp(price) over (w rows between 10 preceding and current row)
                 as rolling_stddev_10,
               size - lag(size, 1) over w as volume_change
        from (select t.symbol, t."timestamp", t.price, t.size, t.trade_id,
                     b."timestamp" as book_timestamp,
                     coalesce(b.top_ask_price, 0.0) - coalesce(b.top_bid_price, 0.0) as spread,
                     coalesce(b.bid_ask_ratio, 0.0) as bid_ask_ratio,
                     coalesce(b.total_bid_volume, 0.0) as total_bid_volume,
                     coalesce(b.total_ask_volume, 0.0) as total_ask_volume
              from (select * from trades where symbol in ('BTCUSDT','ETHUSDT','SOLUSDT')) t
              asof left join vbooks b
                on t.symbol = b.symbol and t."timestamp" >= b."timestamp")
        window w as (partition by symbol order by "timestamp", trade_id)
        qualify row_number() over w >= 11""",
    "gappy": """
        select * replace (
          case when trade_id % 17 = 0 then null else size end as size,
          case when trade_id % 13 = 0 then 'nan'::double else price_change end as price_change,
          case when trade_id % 11 = 0 then 'inf'::double else rolling_avg_5 end as rolling_avg_5,
          case when trade_id % 7 = 0 then 'nan'::double else bid_ask_ratio end as bid_ask_ratio,
          case when trade_id % 19 = 0 then 'inf'::double else spread end as spread)
        from feats""",
    "newest": """
        select * from feats
        qualify row_number() over (partition by symbol order by "timestamp" desc,
          trade_id desc, book_timestamp desc nulls last) <= 500""",
    "series": """
        select *, row_number() over w as rn, count(*) over (partition by symbol) as n
        from feats
        window w as (partition by symbol
                     order by "timestamp", trade_id, book_timestamp nulls first)""",
    "scaled_pairs": """
        select *, lag(y) over (partition by symbol order by rn) as x,
               floor((n - 60) * 0.8::double) as cut
        from (select *, (price - low) / width as y
              from (select *, min(price) over p as low,
                           case when max(price) over p = min(price) over p then 1.0
                                else max(price) over p - min(price) over p end as width
                    from series window p as (partition by symbol)))""",
    "fitted": """
        select symbol, regr_slope(y, x) as slope, regr_intercept(y, x) as intercept,
               min(low) as low, min(width) as width
        from scaled_pairs
        where rn > 60 and rn - 60 <= floor(cut * 0.9::double)
          and rn - 60 > floor(cut * 0.9::double) - 10000
        group by symbol having max(n) >= 70""",
    "scaler": "\n        " + "\n        union all ".join(
        f"select symbol, '{c}' as feature, min({c}) as min, max({c}) as max"
        " from feats group by symbol"
        for c in FEATURE_COLS
    ),
    "preds": """
        select symbol, price as current_price,
               price + (trade_id % 7 - 3) * 0.25::double as predicted_price,
               case when price + (trade_id % 7 - 3) * 0.25::double > price then 'UP'
                    else 'DOWN' end as direction,
               round_even(price + (trade_id % 7 - 3) * 0.25::double - price, 4) as diff,
               "timestamp"
        from vtrades""",
}


def _with(body: str) -> str:
    """Prefix the CTEs in definition order; unused ones cost nothing."""
    return "with " + ",\n".join(
        f"{name} as ({text})" for name, text in _CTES.items()
    ) + "\n" + body


def _r(expression: str, alias: str | None = None, digits: int = 6) -> str:
    return f"floor(({expression}) * 1e{digits} + 0.5) / 1e{digits} as {alias or expression}"


def _all_r(columns: list[str]) -> str:
    return ", ".join(_r(c, digits=4 if "stddev" in c else 6) for c in columns)


_KEY = 'symbol, "timestamp", trade_id, book_timestamp'


def _depth(price: str, step: str, quantity: str, side: str) -> str:
    """A book side of 20 levels as the sums of its prices and quantities, weighted by level."""
    prices = f"list_sum(list_transform(range(20), lambda i: ({price} + i * ({step})) * (i + 1)))"
    return (f"20 as {side}_levels, " + _r(prices, f"{side}_prices", 3) + ", "
            + _r(f"210 * ({quantity})", f"{side}_quantities", 3))
_TOP = ["top_bid_price", "top_ask_price"]
_EXTRA = [c for c in FEATURE_COLS if c not in ("price", "size")]
_ORDERED = '"timestamp", trade_id, book_timestamp nulls first'


def _faults(pairs: list[tuple[str, str]]) -> str:
    texts = ", ".join(f"'{name}: ' || {column}" for column, name in pairs)
    return f"concat_ws('; ', {texts})"


_TRADE_FAULTS = [
    ("f_symbol", "symbol"), ("f_price", "price"), ("f_size", "size"),
    ("f_timestamp", "timestamp"), ("f_trade_id", "trade_id"),
]
_BOOK_FAULTS = [
    ("f_symbol", "symbol"), ("f_bid", "top_bid_price"), ("f_ask", "top_ask_price"),
    ("f_bid_volume", "total_bid_volume"), ("f_ask_volume", "total_ask_volume"),
    ("f_ratio", "bid_ask_ratio"),
]
_TRADE_OK = " and ".join(f"{c} is null" for c, _ in _TRADE_FAULTS)
_BOOK_OK = " and ".join(f"{c} is null" for c, _ in _BOOK_FAULTS)
_BOOK_SCALARS = [
    "top_bid_price", "top_bid_qty", "top_ask_price", "top_ask_qty",
    "total_bid_volume", "total_ask_volume", "bid_ask_ratio",
]
# Depth arrays are built before any value is spoiled.
_DEPTHS = (_depth("value", "-0.01", "(k + 1) * 20.0::double / 20.0::double", "bid_depth") + ", "
           + _depth("value + (k - 5) / 100.0::double", "0.01",
                    "((k * 7) % 100 + 1) * 20.0::double / 20.0::double", "ask_depth"))
_WITH_DEPTH = f"""(select ts_ms as "timestamp", {_DEPTHS} from base
    where event_type in ('purchase', 'signup'))"""
_DEPTH_COLS = ", ".join(
    f"{s}_depth_{c}" for s in ("bid", "ask") for c in ("levels", "prices", "quantities"))
_TRADE_SCALARS = f'symbol, {_all_r(["price", "size"])}, "timestamp", trade_id'


def _fault_counts(table: str, faults: list[tuple[str, str]], entity: str) -> str:
    return " union all ".join(
        f"select '{name}' as field, {column} as message, count(*) as violations,"
        f" '{entity}' as entity from {table} where {column} is not null group by 2"
        for column, name in faults
    )


def _column_counts(table: str, columns: list[str], test: str, alias: str) -> str:
    return " union all ".join(
        f"""select '{c}' as "column", count(*) filter (where {test.format(c=f'"{c}"')})"""
        f" as {alias} from {table}"
        for c in columns
    )


_JOINED = ["symbol", "timestamp", "price", "size", "top_bid_price", "top_ask_price",
           "bid_ask_ratio", "total_bid_volume", "total_ask_volume", "trade_id", "book_timestamp"]
_NUMERIC_FEATS = [c for c in _JOINED if c != "symbol"] + [
    c for c in FEATURE_COLS if c not in _JOINED
]
_LONG_COLS = ("timestamp", "trade_id", "book_timestamp")


def _type(column: str) -> str:
    return {"symbol": "string"}.get(column, "bigint" if column in _LONG_COLS else "double")


def _finite(column: str) -> str:
    return f"case when isfinite({column}) then {column} end"


def _ffill(column: str) -> str:
    if column in ("bid_ask_ratio", "total_bid_volume", "total_ask_volume", "spread"):
        return _r(f"coalesce({_finite(column)}, 0.0)", column)
    filled = f"coalesce(last_value({_finite(column)} ignore nulls) over w, 0.0)"
    return _r(filled, column, 4 if "stddev" in column else 6)


def _scaled(column: str) -> str:
    low, high = f"min({column}) over p", f"max({column}) over p"
    width = f"case when {high} = {low} then 1.0 else {high} - {low} end"
    return _r(f"({column} - {low}) / ({width})", column, 4)


def _scored(trades: str) -> str:
    """The fitted lines applied to every tick that ends a window, from the seventieth on."""
    return f"""
        select symbol, {_r("price", "current_price")}, {_r("predicted", "predicted_price", 3)},
               case when predicted > price then 'UP' else 'DOWN' end as direction,
               {_r("round_even(predicted - price, 4)", "diff", 3)}, "timestamp"
        from (select t.*, (slope * (price - low) / width + intercept) * width + low as predicted,
                     row_number() over (partition by symbol order by "timestamp", trade_id) as rn
              from {trades} t join fitted using (symbol))
        where rn >= 70"""


def _lagged_moments() -> str:
    """Sums over the training windows of each scaled term times each term 0 to 60 rows later."""
    terms = ["one", *FEATURE_COLS]
    scaled = ", ".join(
        f"({c} - min({c}) over p) / case when max({c}) over p = min({c}) over p then 1.0"
        f" else max({c}) over p - min({c}) over p end as {c}" for c in FEATURE_COLS)
    sums = ", ".join(f"sum(a.{p} * b.{q}) as {p}__{q}" for p in terms for q in terms)
    rows = "\n union all ".join(
        f"select symbol, day, lag, '{p}' as term, " + ", ".join(_r(f"{p}__{q} + 0.0001234::double", q, 3) for q in terms) + " from sums"
        for p in terms)
    return f"""
        , units as (
            select symbol, rn, n, "timestamp", 1.0::double as one, {scaled}
            from series window p as (partition by symbol)),
        sums as (
            select a.symbol, strftime(epoch_ms(l."timestamp"), '%Y-%m-%d') as day, (b.rn - a.rn)::integer as lag, {sums}
            from units a join units l on a.symbol = l.symbol and l.rn = a.rn + 60
              join units b on a.symbol = b.symbol and b.rn between a.rn and a.rn + 60
            where a.n >= 70 and a.rn <= floor(floor((a.n - 60) * 0.8::double) * 0.9::double)
            group by all)
        {rows}"""


def _infinite_sum(table: str) -> str:
    return " + ".join(f"count(*) filter (where isinf({c}))" for c in FEATURE_COLS)


def _nan_sum(table: str) -> str:
    return " + ".join(f"count(*) filter (where {c} is null or isnan({c}))" for c in FEATURE_COLS)


def all_oracles() -> dict[str, str]:
    bodies = {
        "parse_trades": f"""
            select symbol, {_r("case when status in ('ok', 'not_trade') or event_id % 53 = 9 then price end", "price")},
                   {_r("case when status in ('ok', 'not_trade') or event_id % 53 = 5 then size end", "size")},
                   "timestamp", trade_id, status as parse_status
            from (select case when event_id % 53 <> 11 then symbol end as symbol, price, size,
                         case when event_id % 53 <> 11 then "timestamp" end as "timestamp",
                         case when event_id % 53 <> 11 then trade_id end as trade_id, event_id,
                         case event_id % 53 when 3 then 'not_trade' when 5 then 'unparseable'
                           when 9 then 'unparseable' when 11 then 'unparseable' else 'ok' end
                           as status
                  from (select *, trade_id as event_id from trades))""",
        "parse_depth": f"""
            select symbol, "timestamp", {_all_r(_BOOK_SCALARS)}, {_DEPTH_COLS}
            from books join {_WITH_DEPTH} using ("timestamp")
            where ("timestamp" // 400) % 53 not in (3, 5, 7)""",
        "parse_depth_status": """
            select symbol, case ("timestamp" // 400) % 53 when 3 then 'empty_book'
                     when 5 then 'unparseable' when 7 then 'unparseable' else 'ok' end
                     as parse_status,
                   count(*) as messages
            from books group by 1, 2""",
        "book_totals": f"""
            select symbol, "timestamp", {_r("total_bid_volume", "bid_total")},
                   {_r("total_ask_volume", "ask_total")} from books""",
        "contract_trade_valid": f"select {_TRADE_SCALARS} from trade_faults where {_TRADE_OK}",
        "contract_trade_dlq": f"""
            select {_TRADE_SCALARS}, 'crypto-prices-dlq' as topic,
                   {_faults(_TRADE_FAULTS)} as error, cast(null as varchar) as seen_at,
                   cast(null as varchar) as original_payload
            from trade_faults where not ({_TRADE_OK})""",
        "contract_orderbook_valid": f"""
            select symbol, "timestamp", {_all_r(_BOOK_SCALARS)}, {_DEPTH_COLS}
            from book_faults join {_WITH_DEPTH} using ("timestamp") where {_BOOK_OK}""",
        "contract_orderbook_dlq": f"""
            select symbol, "timestamp", {_all_r(_BOOK_SCALARS)}, {_DEPTH_COLS},
                   'crypto-orderbook-dlq' as topic, {_faults(_BOOK_FAULTS)} as error,
                   cast(null as varchar) as seen_at, cast(null as varchar) as original_payload
            from book_faults join {_WITH_DEPTH} using ("timestamp") where not ({_BOOK_OK})""",
        "contract_violation_counts":
            _fault_counts("trade_faults", _TRADE_FAULTS, "trade") + " union all "
            + _fault_counts("book_faults", _BOOK_FAULTS, "book"),
        "dedup_exact": f"""
            select {_TRADE_SCALARS} from
              (select distinct * from (select * from trades union all
                 select * from trades where trade_id % 10 = 0))""",
        "dedup_books": f"""
            select symbol, "timestamp", {_all_r(_BOOK_SCALARS)}, {_DEPTH_COLS} from
              (select distinct * from (select * from books union all
                 select * from books where "timestamp" % 4000 = 0))
              join {_WITH_DEPTH} using ("timestamp")""",
        "dedup_report": """
            select count(*) + count(*) filter (where trade_id % 10 = 0) as rows_before,
                   count(*) as rows_after,
                   count(*) filter (where trade_id % 10 = 0) as duplicates_removed
            from trades""",
        "union_parts": f"select {_TRADE_SCALARS} from trades",
        "band_join": f"""
            select {_KEY}, {_all_r([c for c in _JOINED[2:] if c not in _LONG_COLS])}, date
            from joined""",
        "join_quality": f"""
            select count(*) as total, count(top_bid_price) as matched,
                   count(*) - count(top_bid_price) as unmatched,
                   {_r("count(top_bid_price) * 100.0::double / count(*)", "matched_pct")},
                   {_r("(count(*) - count(top_bid_price)) * 100.0::double / count(*)",
                       "unmatched_pct")}
            from joined""",
        "asof_join": f"""
            select {_KEY}, {_all_r(["price", "size", "spread", "bid_ask_ratio",
                                    "total_bid_volume", "total_ask_volume"])} from latest_book""",
        "lag_features": f"""
            select {_KEY}, {_all_r(["price", "price_lag_1", "price_lag_5", "price_lag_10",
                                    "price_change", "price_change_pct", "volume_change"])}
            from feats""",
        "rolling_features": f"""
            select {_KEY}, {_all_r(["rolling_avg_5", "rolling_avg_10", "rolling_stddev_10"])}
            from feats""",
        "feature_projection": f"""
            select {_KEY}, {_all_r(_TOP + FEATURE_COLS)}, market_pressure from feats""",
        "serving_features": f"select {_KEY}, {_all_r(FEATURE_COLS)} from served",
        "null_counts": _column_counts("joined", [*_JOINED, "date"], "{c} is null", "nulls"),
        "nan_counts": _column_counts(
            "gappy", _NUMERIC_FEATS, "{c} is null or isnan({c}::double)", "missing"),
        "profile_joined": " union all ".join(
            f"""select '{c}' as "column", '{_type(c)}' as type, count(*) as rows,
                       count(*) - count("{c}") as nulls, count(*) - count("{c}") as missing
                from joined""" for c in _JOINED),
        "symbol_distribution": "select symbol, count(*) as rows from trades group by 1",
        "price_range": f"""
            select symbol, {_r("min(price)", "min_price")}, {_r("max(price)", "max_price")},
                   {_r("avg(price)", "avg_price")} from feats group by symbol""",
        "quality_expectations": f"""
            select name, {_r("observed")}, {_r("bound")}, passed from (
              select 'btc_rows_at_least' as name,
                     count(*) filter (where symbol = 'BTCUSDT')::double as observed,
                     1000.0::double as bound,
                     count(*) filter (where symbol = 'BTCUSDT') >= 1000 as passed from feats
              union all select 'price_at_least', min(price), 1.0, min(price) >= 1 from feats
              union all select 'price_at_most', max(price), 1e6, max(price) <= 1e6 from feats
              union all select 'zero_average_share_below',
                count(*) filter (where rolling_avg_5 = 0)::double / count(*), 0.01,
                count(*) filter (where rolling_avg_5 = 0)::double / count(*) < 0.01 from feats)""",
        "top_n_recent": f"select {_KEY}, {_all_r(FEATURE_COLS)} from newest",
        "clean_training": f"""
            select {_KEY}, {_all_r(["price"] + [c for c in FEATURE_COLS if c not in
                ("price", "size", "spread", "bid_ask_ratio")])},
                   {_r("case when trade_id % 17 = 0 then null else size end", "size")},
                   {_r("case when trade_id % 19 = 0 then 0.0 else spread end", "spread")},
                   {_r("case when trade_id % 7 = 0 then 0.0 else bid_ask_ratio end",
                       "bid_ask_ratio")}
            from feats where trade_id % 13 <> 0 and trade_id % 11 <> 0""",
        "ffill_features": f"""
            select {_KEY}, {", ".join(_ffill(c) for c in FEATURE_COLS)} from gappy
            window w as (partition by symbol order by {_ORDERED}
                         rows between unbounded preceding and current row)""",
        "residual_bad_values": f"""
            select {_nan_sum("gappy")} as nan_values, {_infinite_sum("gappy")} as infinite_values,
                   'before' as stage from gappy
            union all select 0, 0, 'after'""",
        "scaler_fit": f"""
            select symbol, feature, {_r("min")}, {_r("max")} from scaler""",
        "scaled_features": f"""
            select {_KEY}, {", ".join(_scaled(c) for c in FEATURE_COLS)} from feats
            window p as (partition by symbol)""",
        "inverse_scale": f"select {_KEY}, {_r('price', 'restored_price')} from feats",
        "trainable_symbols": """
            select symbol, count(*) as rows from feats group by 1 having count(*) >= 70""",
        "sequences": f"""
            select symbol, rn - 60 as seq_no, n - 60 as seq_total, "timestamp", {_r("price", "y")},
                   60 as steps, {_r("first_price")}, {_r("last_price")}, {_r("middle_ask_volume")},
                   {_r("price_sum", digits=3)}, {_r("total_ask_volume_sum", digits=3)}
            from (select *, sum(price) over (w rows between 60 preceding and 1 preceding)
                           as price_sum,
                         sum(total_ask_volume) over (w rows between 60 preceding and 1 preceding)
                           as total_ask_volume_sum, lag(price, 60) over w as first_price, lag(price, 1) over w as last_price,
                         lag(total_ask_volume, 30) over w as middle_ask_volume
                  from series window w as (partition by symbol order by rn))
            where rn > 60""",
        "train_test_split": """
            select symbol, part, count(*) as sequences, min(seq_no) as first_seq,
                   max(seq_no) as last_seq
            from (select symbol, rn - 60 as seq_no,
                    case when rn - 60 > floor((n - 60) * 0.8::double) then 'test'
                         when rn - 60 > floor(floor((n - 60) * 0.8::double) * 0.9::double)
                           then 'validation' else 'train' end as part
                  from series where rn > 60) group by 1, 2""",
        "live_windows": f"""
            select symbol, "timestamp", trade_id, {_r("price", "current_price")}, 60 as steps,
                   {_r("first_price")}, {_r("price", "last_price")},
                   {_r("price_sum", digits=3)}, {_r("total_bid_volume_sum", digits=3)}
            from (select *, lag(price, 59) over w as first_price, row_number() over w as rn,
                         sum(price) over (w rows between 59 preceding and current row)
                           as price_sum,
                         sum(total_bid_volume) over (w rows between 59 preceding and current row)
                           as total_bid_volume_sum
                  from served window w as (partition by symbol order by "timestamp", trade_id))
            where rn >= 60""",
        "eval_metrics": f"""
            select symbol, {_r("avg(abs(price - predicted))", "mae")},
                   {_r("sqrt(avg((price - predicted) * (price - predicted)))", "rmse")},
                   {_r("avg(abs((price - predicted) / price)) * 100", "mape")},
                   count(*) as test_records
            from (select *, lag(price, 1) over (partition by symbol order by rn) as predicted
                  from series)
            where rn - 60 > floor((n - 60) * 0.8::double) and rn > 60 group by symbol""",
        "prediction_records": f"""
            select symbol, {_all_r(["current_price", "predicted_price"])}, direction,
                   {_r("diff")}, "timestamp" from preds""",
        "latest_model_run": """
            select symbol, max(strftime(ts, '%Y%m%d_%H%M%S')) as run_id from base group by 1""",
        "latest_price": f"""
            select symbol, {_r('arg_max(price, "timestamp")', "price")},
                   max("timestamp") as "timestamp" from vtrades group by 1""",
        "last_200": f"""
            select symbol, "timestamp", {_r("price")} from vtrades
            qualify row_number() over (partition by symbol order by "timestamp" desc) <= 200""",
        "top_200": f"""
            select symbol, "timestamp", {_r("price")} from vtrades
            order by "timestamp" desc limit 200""",
        "recent_predictions": f"""
            select symbol, {_r("current_price", '"Actual"')},
                   {_r("predicted_price", '"Predicted"')}, {_r("diff", '"Diff"')},
                   direction as "Direction" from preds
            qualify row_number() over (partition by symbol order by "timestamp" desc) <= 10""",
        "chart_outer_join": f"""
            select symbol, t, {_all_r(["actual_price", "predicted_price"])} from (
              select coalesce(a.symbol, p.symbol) as symbol, coalesce(a.t, p.t) as t,
                     a.price as actual_price, p.predicted_price
              from (select symbol, "timestamp" as t, price from vtrades qualify row_number() over
                     (partition by symbol order by "timestamp" desc) <= 200) a
              full join (select * from (select symbol, predicted_price,
                       case when direction = 'UP' then "timestamp" + 100 else "timestamp" end as t
                     from preds) qualify row_number() over
                     (partition by symbol order by t desc) <= 200) p
                on a.symbol = p.symbol and a.t = p.t)
            qualify row_number() over (partition by symbol order by t desc) <= 200""",
        "live_board": """
            select symbol, format('${:,.4f}', price) as live_price,
                   format('${:,.4f}', predicted_price) as predicted_next,
                   printf('%+.4f', diff) as delta, direction
            from (select symbol, arg_max(current_price, "timestamp") as price,
                         arg_max(predicted_price, "timestamp") as predicted_price,
                         arg_max(diff, "timestamp") as diff,
                         arg_max(direction, "timestamp") as direction from preds group by 1)""",
        "sample_rows": f"""
            select {_TRADE_SCALARS} from vtrades order by "timestamp", trade_id limit 5""",
        "missing_columns": " union all ".join(
            f"""select '{c}' as "column", count(*) as rows_without from joined"""
            for c in FEATURE_COLS if c not in _JOINED),
        "dropped_rows": """
            select symbol, count(*) filter (where trade_id % 13 <> 0) as kept,
                   (select count(*) from feats) as rows_before,
                   (select count(*) from feats where trade_id % 13 <> 0) as rows_after,
                   (select count(*) from feats where trade_id % 13 = 0) as dropped
            from feats group by symbol""",
        "walk_forward": """
            select symbol, least(cast(floor((rn - 61) * 5 / (n - 60)) as bigint), 4) as fold,
                   count(*) as sequences, max(rn - 60) as last_seq
            from series where rn > 60 group by 1, 2""",
        "stream_last_points": f"""
            select symbol, "timestamp", {_r("price")} from vtrades
            qualify row_number() over (partition by symbol order by "timestamp" desc) <= 200""",
        "stream_contract_split": f"""
            select case when {_TRADE_OK} then 'raw' else 'errors' end as zone,
                   case when {_TRADE_OK} then 'crypto-prices' else 'crypto-prices-dlq' end
                     as topic,
                   case when not ({_TRADE_OK}) then {_faults(_TRADE_FAULTS)} end as error,
                   case when not ({_TRADE_OK}) then 'crypto-prices' end as from_topic,
                   {_TRADE_SCALARS}
            from trade_faults""",
        "stream_dedup": f"select {_TRADE_SCALARS} from trades",
        "stream_interval_join": f"""
            select {_KEY}, {_all_r([c for c in _JOINED[2:] if c not in _LONG_COLS])}
            from joined""",
        "features_by_date": f"""
            select {_KEY}, cast(day as varchar) as date, {_all_r(["price", "price_lag_1",
                "price_lag_10", "rolling_avg_5", "rolling_avg_10", "volume_change"])}
            from (select *, lag(price, 1) over w as price_lag_1,
                         lag(price, 10) over w as price_lag_10,
                         avg(price) over (w rows between 5 preceding and current row)
                           as rolling_avg_5,
                         avg(price) over (w rows between 10 preceding and current row)
                           as rolling_avg_10,
                         size - lag(size, 1) over w as volume_change
                  from (select *, cast(date as date) + case when "timestamp" < 1704067300000
                                    then 0 else 1 end as day from joined)
                  window w as (partition by symbol, day order by {_ORDERED}))
            where price_lag_10 is not null""",
        "fit_and_evaluate": f"""
            select symbol, {_r("avg(abs(price - predicted))", "mae", 4)},
                   {_r("sqrt(avg((price - predicted) * (price - predicted)))", "rmse", 4)},
                   {_r("avg(abs((price - predicted) / price)) * 100", "mape", 4)},
                   cast(max(cut) as bigint) as train_records, count(*) as test_records,
                   1 as epochs_trained, '20240101_000000' as run_id
            from (select p.*, (slope * x + intercept) * p.width + p.low as predicted
                  from scaled_pairs p join fitted using (symbol))
            where rn > 60 and rn - 60 > cut group by symbol""",
        "window_moments": _lagged_moments(),
        "fit_all_inputs": """
            select symbol, 900 as inputs,
                   cast(floor(floor((max(n) - 60) * 0.8::double) * 0.9::double) as bigint) as windows,
                   0.0::double as residual, 0.0::double as gradient
            from series group by symbol having max(n) >= 70""",
        "score_batch": _scored("vtrades"),
        "stream_scoring": _scored(
            "(select * from trades where symbol in ('BTCUSDT','ETHUSDT','SOLUSDT'))"),
        "merge_raw_day": f"""
            select {_TRADE_SCALARS},
                   (select count(*) + count(*) filter (where trade_id % 10 = 0) from trades
                    where trade_id % 29 = 0) as unreadable
            from vtrades""",
        "daily_layers": """
            select 'merged/crypto-prices' as layer, count(*) as rows from vtrades
            union all select 'merged/crypto-orderbook', count(*) from vbooks
            union all select 'joined', count(*) from joined
            union all select 'daily', count(*) from feats""",
        "stream_publish": f"""
            select symbol, {_all_r(["current_price", "predicted_price"])}, direction,
                   {_r("diff")}, "timestamp" from preds""",
        "stream_features": f"select {_KEY}, {_all_r(FEATURE_COLS)} from live",
        "stream_latest_price": f"""
            select symbol, {_r('arg_max(price, "timestamp")', "price")},
                   max("timestamp") as "timestamp" from vtrades group by 1""",
    }
    bodies["stream_chart"] = bodies["chart_outer_join"]
    bodies["stream_resend"] = bodies["stream_publish"]
    bodies["dedup_incremental"] = f"select {_TRADE_SCALARS} from vtrades"
    bodies["footer_profile"] = "\n union all ".join(
        f"""select '{c}' as column, '{kind}' as type, count(*) as rows, count(*) - count({c}) as nulls,
                   {f"min({c})::varchar" if bounded else "null"} as least,
                   {f"max({c})::varchar" if bounded else "null"} as most from joined"""
        for c, kind, bounded in (
            ("symbol", "string", False), ('"timestamp"', "bigint", True), ("price", "double", False),
            ("top_bid_price", "double", False), ("trade_id", "bigint", True))).replace("'\"timestamp\"'", "'timestamp'")
    return {name: _with(body) for name, body in bodies.items()}
