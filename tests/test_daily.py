import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickloom.functions.contracts import book_contract, trade_contract
from tickloom.operators import models, training
from tickloom.operators.contract import check, valid_records
from tickloom.operators.features import BY_DATE, build_features, order_ticks
from tickloom.operators.joins import band_join
from tickloom.operators.quality import expectations, join_quality, layer_size, profile
from tickloom.plans import daily, gates
from tickloom.session import create_text, materialize, shared_folder
from tickloom.schemas import BOOK_TOPIC, FEATURE_COLS, TRADE_TOPIC
from tickloom.sources import footers, lake, registry, versions
from tickloom.sources.events import books_of, read_events, trades_of, with_copies
from tickloom.streaming.landing import route, write_routed

DATE = "2024-01-01"


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """A lake with one landed day, copies included."""
    folder = str(tmp_path_factory.mktemp("lake"))
    base = read_events(spark, "/root/testdata/sf0.001")
    day = F.timestamp_seconds(F.lit(1_704_067_200))
    for topic, df in (
        (TRADE_TOPIC, with_copies(trades_of(base), "trade_id")), (BOOK_TOPIC, books_of(base))
    ):
        messages = df.select(F.to_json(F.struct("*")).alias("value"), day.alias("ingested_at"))
        write_routed(route(messages, topic), folder, "q-0")
    return folder


@pytest.fixture(scope="module")
def report(spark, root):
    return daily.run_daily(spark, root, DATE)


def test_daily_run_equals_the_operators(spark, root, report):
    base = read_events(spark, "/root/testdata/sf0.001")
    trades = valid_records(check(trades_of(base), trade_contract()))
    books = valid_records(check(books_of(base), book_contract()))
    joined = band_join(trades, books).withColumn("date", F.lit(DATE).cast("date"))
    wanted = build_features(order_ticks(joined, BY_DATE))
    got = lake.read_layer(spark, root, daily.FEATURES, DATE)
    cols = ["symbol", "timestamp", "trade_id", "book_timestamp", *FEATURE_COLS]
    assert got.select(*cols).exceptAll(wanted.select(*cols)).count() == 0
    assert got.count() == wanted.count() == report[daily.FEATURES]["rows"]
    assert report[TRADE_TOPIC]["rows_before"] > report[TRADE_TOPIC]["rows_after"] == trades.count()


def test_rerun_replaces_the_date(spark, root, report):
    assert daily.run_daily(spark, root, DATE) == report


def test_other_dates_stay(spark, root, report):
    other = lake.read_layer(spark, root, daily.FEATURES, DATE).drop("date").limit(5)
    lake.write_date(other, root, daily.FEATURES, "2023-12-31")
    daily.run_daily(spark, root, DATE)
    assert lake.read_layer(spark, root, daily.FEATURES, "2023-12-31").count() == 5
    lake.write_date(other.limit(0), root, daily.FEATURES, "2023-12-31")


def test_training_run_registers_models(spark, root, report):
    metrics = daily.run_training(spark, root, "20240102_000000", rows_per_symbol=120)
    rows = metrics.orderBy("symbol").collect()
    assert rows and all(r["mae"] >= 0 and r["test_records"] > 0 for r in rows)
    daily.run_training(spark, root, "20240103_000000", rows_per_symbol=100, fit_on="train")
    status = registry.read_status(spark, root).where("run_id = '20240103_000000'").collect()
    assert sorted(r["symbol"] for r in status if r["status"] == "trained") == [r["symbol"] for r in rows]
    fitted, scaler = registry.load_latest(spark, root)
    assert sorted(fitted) == [r["symbol"] for r in rows]
    assert scaler.count() == len(fitted) * len(FEATURE_COLS)
    assert registry.read_metrics(spark, root).count() == 2 * len(rows)


def files_below(spark, folder):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(path).getFileCount()


def test_runs_leave_no_scratch(spark, root, report):
    before = files_below(spark, shared_folder(spark))
    daily.run_daily(spark, root, DATE)
    daily.run_training(spark, root, "20240104_000000")
    assert files_below(spark, shared_folder(spark)) == before


def test_joined_layer_has_its_columns_alone(spark, root, report):
    columns = lake.read_layer(spark, root, daily.JOINED, DATE).columns
    assert not {"block", "from_end", "carried"} & set(columns)


def test_scaler_of_the_training_part_sees_what_sequences_see(spark):
    rows = spark.range(160).select(
        F.lit("BTCUSDT").alias("symbol"), F.col("id").alias("timestamp"),
        *[F.col("id").cast("double").alias(c) for c in FEATURE_COLS])
    # 100 sequences, 80 of them train; the last of these has its label in row 140.
    assert daily._scaler_rows(rows, "train").agg(F.max("price")).first()[0] == 139.0


def test_fit_bound_takes_the_newest_training_sequences(spark):
    seen = []

    class Estimator:
        def fit(self, df):
            seen.append(df.count())

    split = spark.range(1, 101).select(
        F.lit("BTCUSDT").alias("symbol"), F.col("id").alias("seq_no"), F.lit(100).alias("seq_total"),
        F.array(F.array(F.lit(1.0))).alias("x"), F.lit(1.0).alias("y"),
        F.when(F.col("id") <= 72, "train").otherwise("test").alias("part"))
    for newest in (None, 10, 1000):
        models.fit_symbol(split, "BTCUSDT", Estimator(), newest)
    assert seen == [72, 10, 72]


def test_text_numbers_and_cut_lines_reach_the_merged_layer(spark, tmp_path):
    """Landing takes numbers sent as text; the merge must keep them, and count broken lines."""
    at = F.timestamp_seconds(F.lit(1_704_067_200))
    good = [
        '{"symbol":"BTCUSDT","price":"100.5","size":1,"timestamp":1704067200001.0,"trade_id":"7"}',
        '{"symbol":"ETHUSDT","price":2.5,"size":"0.25","timestamp":1704067200002,"trade_id":8,"venue":"x"}']
    lines = spark.createDataFrame([(g,) for g in good], "value string").withColumn("ingested_at", at)
    write_routed(route(lines, TRADE_TOPIC), str(tmp_path), "q-0")
    cut = spark.createDataFrame([(good[0][:40],), ("",)], "value string").select(
        "value", at.alias("ingested_at"), F.lit("raw").alias("zone"), F.lit(TRADE_TOPIC).alias("topic"))
    write_routed(cut, str(tmp_path), "q-1")
    counts = daily.merge_topic(spark, str(tmp_path), TRADE_TOPIC, DATE)
    merged = lake.read_layer(spark, str(tmp_path), daily.merged_layer(TRADE_TOPIC), DATE).drop("date")
    assert sorted(map(tuple, merged.collect())) == [
        ("BTCUSDT", 100.5, 1.0, 1704067200001, 7), ("ETHUSDT", 2.5, 0.25, 1704067200002, 8)]
    assert counts["unreadable"] >= 1 and counts["rows_after"] == 2


def test_missing_raw_day_fails_the_gate(spark, root):
    with pytest.raises(gates.GateError, match="no raw files"):
        daily.run_daily(spark, root, "2020-05-05")


def test_gates(spark, root, report, tmp_path):
    with pytest.raises(gates.GateError):
        gates.layer_has_rows(spark, root, daily.FEATURES, "2020-01-01")
    with pytest.raises(gates.GateError):
        gates.layer_has_rows(spark, root, "nothing")
    with pytest.raises(gates.GateError, match="price_lag_1"):
        gates.feature_columns_present(spark.createDataFrame([("a",)], "symbol string"))
    with pytest.raises(gates.GateError, match="no files"):
        gates.training_layer_usable(spark, str(tmp_path), "training")
    spark.range(1).write.parquet(f"{tmp_path}/training")
    with pytest.raises(gates.GateError, match="small"):
        gates.training_layer_usable(spark, str(tmp_path), "training")
    size = layer_size(spark, f"{root}/{daily.FEATURES}").first()
    assert size["files"] >= 1 and size["bytes"] > 1024


def test_reports(spark, root, report):
    joined = lake.read_layer(spark, root, daily.JOINED, DATE)
    quality = join_quality(joined).first()
    assert quality["total"] == quality["matched"] + quality["unmatched"] == joined.count()
    assert join_quality(joined.limit(0)).first()["matched_pct"] is None
    rows = {r["column"]: r for r in profile(joined).collect()}
    assert rows["top_bid_price"]["nulls"] == quality["unmatched"]
    assert rows["price"]["type"] == "double"
    failed = expectations(lake.read_layer(spark, root, daily.FEATURES, DATE)).where("not passed")
    with pytest.raises(gates.GateError, match="btc_rows_at_least"):
        gates.expectations_met(failed)


def test_a_run_that_fails_a_gate_leaves_what_was_there(spark, root, report, monkeypatch):
    before = {layer: sorted(map(str, lake.read_layer(spark, root, layer, DATE).collect()))
              for layer in (daily.merged_layer(TRADE_TOPIC), daily.JOINED, daily.FEATURES)}
    held = lake.read_layer(spark, root, daily.FEATURES, DATE)  # a reader that is still at it

    def fails(df):
        raise gates.GateError("not good enough")
    monkeypatch.setattr(gates, "feature_columns_present", fails)
    extra = '{"symbol":"BTCUSDT","price":9.5,"size":1,"timestamp":1704067200001,"trade_id":99999999}'
    at = F.timestamp_seconds(F.lit(1_704_067_200))
    lines = spark.createDataFrame([(extra,)], "value string").withColumn("ingested_at", at)
    write_routed(route(lines, TRADE_TOPIC), root, "q-extra")
    try:
        with pytest.raises(gates.GateError):
            daily.run_daily(spark, root, DATE)
        for layer, rows in before.items():
            assert sorted(map(str, lake.read_layer(spark, root, layer, DATE).collect())) == rows
        monkeypatch.undo()
        daily.run_daily(spark, root, DATE)
        assert lake.read_layer(spark, root, daily.merged_layer(TRADE_TOPIC), DATE).where("trade_id = 99999999").count() == 1
        assert sorted(map(str, held.collect())) == before[daily.FEATURES]
    finally:
        shutil.rmtree(next(Path(root).rglob("batch=q-extra")))


def test_old_versions_go_and_two_writers_do_not_meet(spark, tmp_path):
    root = str(tmp_path)
    for i in range(5):
        lake.write_date(spark.range(i, i + 1), root, "layer", DATE)
        lake.write_table(spark.range(i), root, "table")
    assert [r["id"] for r in lake.read_layer(spark, root, "layer", DATE).collect()] == [4]
    assert lake.read_layer(spark, root, "table").count() == 4
    assert len(list((tmp_path / "layer" / f"date={DATE}").iterdir())) == versions.KEPT
    assert lake.read_layer(spark, root, "layer", "2030-01-01").isEmpty()
    path = lake.layer_path(root, "layer")
    assert not create_text(spark, f"{path}/_manifest/{versions.manifest(spark, path).number:08d}", "{}")


@pytest.mark.parametrize("whole_first", [False, True])
def test_landed_files_are_merged_as_they_come(spark, tmp_path, whole_first):
    """The second landing reads new files alone: the first ones are gone by then."""
    root, base = str(tmp_path), read_events(spark, "/root/testdata/sf0.001")
    trades = with_copies(trades_of(base), "trade_id")
    at = F.timestamp_seconds(F.lit(1_704_067_200))
    layer = daily.merged_layer(TRADE_TOPIC)
    for i in range(3):  # the parts overlap by a third
        part = trades.where(F.col("trade_id") % 3 != i)
        messages = part.select(F.to_json(F.struct("*")).alias("value"), at.alias("ingested_at"))
        write_routed(route(messages, TRADE_TOPIC), root, f"q-{i}")
        if whole_first and not i:
            daily.merge_topic(spark, root, TRADE_TOPIC, DATE)
        else:
            assert daily.merge_landed(spark, root, TRADE_TOPIC, DATE)["files"] == 1
        # What has been merged is not read again.
        for file in Path(lake.raw_day_path(root, TRADE_TOPIC, DATE)).rglob("*.txt"):
            file.write_text("gone")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    found = lake.read_layer(spark, root, layer, DATE).drop("date")
    known = trades.where(F.col("symbol").isin("BTCUSDT", "ETHUSDT", "SOLUSDT"))
    wanted = valid_records(check(known, trade_contract())).dropDuplicates()
    assert found.exceptAll(wanted.select(*found.columns)).count() == 0 and found.count() == wanted.count()
    assert daily.merge_landed(spark, root, TRADE_TOPIC, DATE)["files"] == 0
    assert lake.seen_hashes(spark, root, layer, DATE).count() == found.count()


def test_footers_tell_what_a_scan_tells(spark, root, report):
    layer = lake.read_layer(spark, root, daily.JOINED, DATE).drop("date")
    folders = lake.layer_folders(spark, root, daily.JOINED, DATE)
    scanned = {r["column"]: r for r in profile(layer).collect()}
    told = {r["column"]: r for r in footers.footer_profile(spark, folders).collect()}
    assert set(told) == set(scanned) and told["top_bid_price"]["nulls"] > 0
    for column, row in told.items():
        assert (row["rows"], row["nulls"], row["type"]) == tuple(scanned[column][k] for k in ("rows", "nulls", "type"))
    bounds = layer.agg(F.min("timestamp"), F.max("timestamp")).first()
    assert (told["timestamp"]["least"], told["timestamp"]["most"]) == tuple(map(str, bounds))
    # The scans read counts and bounds, not columns.
    table = footers._table(spark, folders)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (
        footers.footer_counts(table, ["symbol", "timestamp"]), footers.footer_bounds(table, ["timestamp"]))]
    assert "ReadSchema: struct<count(*):bigint,count(symbol):bigint" in plans[0]
    assert "ReadSchema: struct<min(timestamp):bigint,max(timestamp):bigint>" in plans[1]
    gates.columns_filled(spark, root, daily.JOINED, ["symbol", "price"], DATE)
    with pytest.raises(gates.GateError, match="top_bid_price"):
        gates.columns_filled(spark, root, daily.JOINED, ["top_bid_price"], DATE)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_footers_of_files_without_values_or_rows(spark, tmp_path):
    """One file has nothing but nulls in ``n``, one has no rows."""
    parts = [[(1, 5), (2, 6)], [(3, None)], []]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "id long, n long").coalesce(1).write.parquet(f"{tmp_path}/{i}")
    paths = [f"{tmp_path}/{i}" for i in range(3)]
    told = {r["column"]: tuple(r)[2:] for r in footers.footer_profile(spark, paths).collect()}
    assert told == {"id": (3, 0, "1", "3"), "n": (3, 1, None, None)}
    assert [tuple(r)[2:] for r in footers.footer_profile(spark, paths[2:]).collect()] == [(0, 0, None, None)] * 2
    assert footers.footer_rows(spark, paths) == 3 and footers.footer_rows(spark, paths[2:]) == 0
    # Arrays are stored as one column, so what follows them is found; structs are not.
    spark.sql("select array(array(1.5)) as depth, id, if(id = 0, null, id) as gap from range(3)").write.parquet(f"{tmp_path}/a")
    told = {r["column"]: tuple(r)[2:] for r in footers.footer_profile(spark, [f"{tmp_path}/a"]).collect()}
    assert told == {"id": (3, 0, "0", "2"), "gap": (3, 1, None, None)}
    spark.sql("select struct(1 as a, 2 as b) as s, id from range(3)").write.parquet(f"{tmp_path}/s")
    with pytest.raises(ValueError, match="several"):
        footers.footer_profile(spark, [f"{tmp_path}/s"])


def test_every_symbol_has_a_status(spark):
    def table(*symbols):
        return spark.createDataFrame([(s,) for s in symbols], "symbol string")
    rows = table(*["a"] * 5, *["b"] * 2, *["c"] * 5, *["d"] * 5)
    found = models.training_status(["a", "b", "c", "d", "e"], rows, table("c"), table("a"), 3).collect()
    assert {r["symbol"]: (r["rows"], r["status"]) for r in found} == {
        "a": (5, "trained"), "b": (2, "too few rows"), "c": (5, "missing values"), "d": (5, "no usable prediction"),
        "e": (0, "no rows")}


def test_models_of_both_kinds_score_side_by_side(spark, tmp_path):
    """A run with an estimator leaves files, one without a table; the latest of each symbol counts."""
    root = str(tmp_path)
    rows = spark.range(300).select(
        F.when(F.col("id") % 2 == 0, "BTCUSDT").otherwise("ETHUSDT").alias("symbol"), F.col("id").alias("timestamp"),
        *[(F.sin(F.col("id") * (i + 1)) + F.col("id") / 100).alias(c) for i, c in enumerate(FEATURE_COLS)])
    for run, symbols, estimator in (
            ("r1", ["BTCUSDT", "ETHUSDT"], None), ("r2", ["ETHUSDT"], models.next_price_regressor())):
        clean = materialize(rows.where(F.col("symbol").isin(symbols)), "clean")
        registry.save_metrics(daily.train_and_evaluate(spark, root, run, clean, estimator), root, run)
    fitted, scaler = registry.load_latest(spark, root)
    assert list(fitted) == ["BTCUSDT", "ETHUSDT"] and list(fitted.others) == ["ETHUSDT"]
    series = training.order_series(training.scale(rows, materialize(scaler, "scaler")))
    scored = models.score_windows(training.build_sequences(series), fitted, scaler)
    assert {r["symbol"]: r["n"] for r in scored.where("predicted_price is not null").groupBy("symbol").agg(
        F.count("*").alias("n")).collect()} == {"BTCUSDT": 90, "ETHUSDT": 90}
