import gzip
import hashlib
import io

from pyspark.sql import functions as F

from tickloom.llm import warc
from tickloom.session import scratch_path

PAGES = "page_id long, url string, html string, file string, digest string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], PAGES)


def expected(rows):
    first = {}
    for i, _, h in rows:
        body = (h or "").encode()
        if len(body) >= 100 and i is not None:
            first[body] = min(i, first.get(body, i))
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        to = first.get(body)
        to = None if to == i or sum((x[2] or "") == (h or "") for x in rows) < 2 else to
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a/1", "copy " * 40), (2, "http://a/2", "copy " * 40), (0, None, "copy " * 40), (3, "u\r\nv: w", "short"),
    (4, "u", "short"), (5, "u", None), (6, "u", ""), (7, "u", "ünï 漢 " * 30), (7, "u", "ünï 漢 " * 30), (8, "u", "ünï 漢 " * 30),
    (None, "u", "copy " * 40), (None, "u", "alone " * 40), (9, "u", "x\r\n\r\ny" * 50_000), (10, "u", "WARC/1.1\r\n" * 90),
]


def test_round_trip(spark):
    source = pages(spark, ROWS).repartition(3)
    for split in (64, 1000, warc.SPLIT):
        found = warc.archived(source, split=split)
        rows = found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert sorted(map(tuple, rows), key=repr) == expected(ROWS)
    for r in found.where("record_type = 'response'").collect():
        assert any(i == r.page_id and (h or "").encode() == bytes(r.payload) for i, _, h in ROWS)
    assert warc.archived(pages(spark, [])).count() == 0


def test_files_are_gzip_members_that_anyone_can_read(spark, tmp_path):
    files = warc.write(pages(spark, ROWS).coalesce(1), f"file://{tmp_path}").collect()
    text = gzip.decompress((tmp_path / files[0].file).read_bytes())
    assert text.count(b"WARC-Type: ") >= len(ROWS) and text.startswith(b"WARC/1.1\r\n")
    assert files[0].records == len(ROWS)


def test_ranges_own_what_starts_inside_them():
    bodies = [bytes([i]) * (i * 37 % 5000) for i in range(60)]
    blob, starts = b"", []
    for i, b in enumerate(bodies):
        starts.append(len(blob))
        blob += warc.record(str(i), None, b, "", None)
    for split in (1, 7, 100, 5000, len(blob)):
        if split < 100 and len(blob) > 20_000:
            ranges = [(a, a + split) for a in range(0, 3000, split)]
        else:
            ranges = [(a, a + split) for a in range(0, len(blob), split)]
        found = [p for a, b in ranges for p, _ in warc.members(io.BytesIO(blob), a, b)]
        assert found == [s for s in starts if s < ranges[-1][1]]


def test_false_magic_and_damage_are_passed_over():
    good = [warc.record(str(i), None, b"page %d" % i, "", None) for i in range(3)]
    other = gzip.compress(b"no record at all")
    cut = warc.record("9", None, b"lost " * 100, "", None)[:60]
    blob = good[0] + warc._MAGIC + b"junk" + other + good[1] + cut + good[2]
    found = [warc._parsed(m)["page_id"] for _, m in warc.members(io.BytesIO(blob), 0, len(blob))]
    assert found == ["0", "1", "2"]


def test_files_of_failed_attempts_are_not_read(spark):
    folder = scratch_path(spark, "warc-attempts")
    folder = folder if folder.startswith("file:") else f"file://{folder}"
    kept = warc.write(pages(spark, ROWS[:4]), folder)
    warc.write(pages(spark, ROWS[4:8]), folder)
    found = warc.read(spark, folder, kept).select(F.col("page_id")).collect()
    assert sorted(r.page_id for r in found) == [0, 1, 2, 3]


def archive(*heads):
    return b"".join(gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\n" + h + b"\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n") for h in heads)


def test_broken_headers_and_foreign_ids(spark, tmp_path):
    blob = archive(
        b"WARC-Record-ID: <urn:uuid:0f1e>", b"WARC-Record-ID: <urn:uuid:0f1e>\r\nContent-Length: many",
        b"WARC-Record-ID: <urn:uuid:0f1e>\r\nContent-Length: 23", b"WARC-Record-ID: <urn:page:7>\r\nContent-Length: 23")
    (tmp_path / "a.warc.gz").write_bytes(blob)
    files = spark.createDataFrame([("a.warc.gz", len(blob))], "file string, bytes long")
    found = warc.read(spark, str(tmp_path), files).collect()
    assert [(r.page_id, bytes(r.payload)) for r in found] == [(None, b"body"), (7, b"body")]


def test_a_folder_without_a_scheme_is_on_the_default_file_system(spark):
    assert warc.reachable(spark, "/some/folder") == "file:///some/folder"
    assert warc.reachable(spark, "file:/some/folder") == "file:///some/folder"
    conf, name = spark.sparkContext._jsc.hadoopConfiguration(), "fs.defaultFS"
    before = conf.get(name)
    conf.set(name, "viewfs://store/")
    conf.set("fs.viewfs.mounttable.store.link./some", "file:///tmp")
    try:
        assert warc.reachable(spark, "/some/folder") == "viewfs://store/some/folder"
    finally:
        conf.set(name, before)


def test_a_long_record_is_read_in_pieces():
    body = bytes(range(256)) * 40_000
    blob = warc.record("1", None, body, "", None) + warc.record("2", None, b"x", "", None)
    found = [warc._parsed(m)["payload"] for _, m in warc.members(io.BytesIO(blob), 0, len(blob))]
    assert found == [body, b"x"]
