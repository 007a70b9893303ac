"""WARC archives: writing them from tasks, and a splittable reader.

Each record is a gzip member of its own. The reader cuts files into byte ranges; a task looks for the
gzip magic in its range, takes a place as a member only if it decodes to a WARC header, and owns the
records that start inside the range, however far they reach beyond it.
"""

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import arrow_rows, materialize
from tickloom.session import qualified, scratch_path

#: Payloads below this many bytes are always written whole.
MIN_REVISIT = 100
#: Bytes of a range.
SPLIT = 4 << 20
#: Date of all records, a parameter so that reruns write the same bytes.
DATE = datetime(2024, 1, 1, tzinfo=timezone.utc)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MAGIC, _START = b"\x1f\x8b\x08", b"WARC/1."
_CHUNK, _BITE = 1 << 20, 1 << 13
_ID = "urn:page:"

RECORDS = ("page_id string, url string, record_type string, refers_to string, payload_bytes long, "
           "payload_digest string, payload binary, file string, position long")


def planned(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Pages with their payload and, for a copy, the page that it revisits.

    Of equal payloads the smallest page id is written whole; of rows that share it and of rows
    without ids, all are.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    digest = F.sha2("payload", 256)
    firsts = rows.where(F.octet_length("payload") >= min_revisit).groupBy(digest.alias("d")) \
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    copy_of = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.withColumn("digest", digest).join(firsts, F.col("digest") == F.col("d"), "left") \
        .select("page_id", "url", "payload", "digest", copy_of.alias("copy_of"))


def record(page_id: str | None, url: str | None, payload: bytes, digest: str, copy_of: str | None) -> bytes:
    """One record as a gzip member. A revisit has the HTTP header, with the payload's length, alone."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if copy_of is not None else http + payload
    fields = [
        ("WARC-Type", "response" if copy_of is None else "revisit"),
        ("WARC-Record-ID", f"<{_ID}{page_id or ''}>"),
        ("WARC-Date", DATE.strftime("%Y-%m-%dT%H:%M:%SZ")),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(url.splitlines())))
    if copy_of is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{_ID}{copy_of}>")]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block + b"\r\n\r\n") + packer.flush()


def reachable(spark: SparkSession, folder: str) -> str:
    """The folder as a URI that ``pyarrow.fs`` takes; without a scheme it is on the default file system."""
    whole = qualified(spark, folder)
    scheme, _, rest = whole.partition(":")
    if scheme == "file":
        return "file:///" + rest.lstrip("/")
    return f"s3:{rest}" if scheme == "s3a" else whole


def write(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write one archive for each task into ``folder``, which all executors share; list them.

    A file gets its name from the attempt that writes it and counts only if the stored list, which
    takes what a task returns when it succeeds, has it. A task that is run again, or twice, leaves a
    file that no one reads.
    """
    folder = reachable(pages.sparkSession, folder)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        name, out, n = f"{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            out = out or system.open_output_stream(f"{path}/{name}", compression=None)
            for row in batch.itertuples(index=False):
                out.write(record(*row))
                n += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pd.DataFrame({"file": [name], "bytes": [size], "records": [n]})

    # Ids travel as text: pandas would turn longs with nulls into doubles.
    texts = planned(pages, min_revisit).withColumns(
        {c: F.col(c).cast("string") for c in ("page_id", "copy_of")})
    with arrow_rows(pages.sparkSession, 256):
        return materialize(texts.mapInPandas(rows, "file string, bytes long, records long"), "archives")


def _length(text: str | bytes) -> int | None:
    """The number in a length header; None if it is none."""
    text = text.strip()
    return int(text) if text.isdigit() and text.isascii() else None


def _parsed(member: bytes) -> dict | None:
    """The fields of a response or revisit; None for other records and for headers that don't parse."""
    head, _, rest = member.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    kind = fields.get("WARC-Type")
    if kind not in ("response", "revisit"):
        return None
    size = _length(fields.get("Content-Length", ""))
    if size is None:
        return None
    block = rest[:size]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = next((_length(x.split(b":", 1)[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
    length = len(payload) if told is None else told
    page = lambda name: fields.get(name, "").strip("<>").removeprefix(_ID) or None
    whole = kind == "response"
    return {
        "page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": kind,
        "refers_to": page("WARC-Refers-To"), "payload": payload if whole else None,
        "payload_bytes": len(payload) if whole else length,
        "payload_digest": hashlib.sha256(payload).hexdigest() if whole
        else fields.get("WARC-Payload-Digest", "").removeprefix("sha256:")}


class _Window:
    """A file read forward in chunks, with what lies before the current place let go."""

    def __init__(self, file, start: int):
        self.file, self.start, self.data = file, start, bytearray()
        file.seek(start)

    def grow(self) -> bool:
        more = self.file.read(_CHUNK)
        self.data += more
        return bool(more)

    def drop_to(self, place: int) -> None:
        if place - self.start >= _CHUNK:
            del self.data[:place - self.start]
            self.start = place


def _member(window: _Window, place: int) -> tuple[bytes, int] | None:
    """The decoded member at ``place`` and where it ends; None if it is no whole WARC record."""
    unpack, parts, at, known = zlib.decompressobj(31), [], place, False
    try:
        while not unpack.eof:
            if at >= window.start + len(window.data) and not window.grow():
                return None
            chunk = bytes(window.data[at - window.start:at - window.start + _BITE])
            parts.append(unpack.decompress(chunk))
            at += len(chunk) - len(unpack.unused_data)
            if not known and sum(map(len, parts)) >= len(_START):
                parts, known = [b"".join(parts)], True
                if not parts[0].startswith(_START):
                    return None
    except zlib.error:
        return None
    whole = b"".join(parts)
    return (whole, at) if whole.startswith(_START) else None


def members(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Place and bytes of the records that start in [start, end), after any damage too."""
    window, place = _Window(file, start), start
    while place < end:
        found = window.data.find(_MAGIC, place - window.start)
        if found < 0:  # the last bytes may begin the magic
            place = max(place, window.start + len(window.data) - len(_MAGIC) + 1)
            window.drop_to(place)
            if not window.grow():
                return
            continue
        place = window.start + found
        window.drop_to(place)
        if place >= end:
            return
        got = _member(window, place)
        if got is None:
            place += 1
            continue
        yield place, got[0]
        place = got[1]


def read(spark: SparkSession, folder: str, files: DataFrame, split: int = SPLIT) -> DataFrame:
    """The records of the listed archives (``file``, ``bytes``) in ``folder``, each read by one task.

    Ids that are no numbers, such as those of archives from elsewhere, are null; records whose headers
    don't parse are passed over.
    """
    folder = reachable(spark, folder)
    ranges = files.select("file", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split).cast("long"))).alias("start"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start in zip(batch["file"], batch["start"]):
                found, held = [], 0
                with system.open_input_file(f"{path}/{name}") as file:
                    for place, member in members(file, start, start + split):
                        parsed = _parsed(member)
                        if parsed is None:
                            continue
                        found.append(parsed | {"file": name, "position": place})
                        held += len(member)
                        if held > 16 << 20:
                            yield _frame(found)
                            found, held = [], 0
                if found:
                    yield _frame(found)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(parts, "file", "start").mapInPandas(rows, RECORDS).withColumns(
        {c: F.col(c).try_cast("long") for c in ("page_id", "refers_to")})


def _frame(found: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(found, columns=[c.split()[0] for c in RECORDS.split(", ")])


def archived(pages: DataFrame, folder: str | None = None, min_revisit: int = MIN_REVISIT, split: int = SPLIT) -> DataFrame:
    """Write ``pages`` as archives and read the records back.

    Null html is an empty payload. Payloads of at least ``min_revisit`` bytes that equal one another
    are written once, under the smallest page id; rows that share this id and rows without an id
    are responses too. Line breaks in a url are left out, a null url has no header. An empty table
    makes no file and gives no rows; extra columns are ignored.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    return read(spark, folder, write(pages, folder, min_revisit), split)
