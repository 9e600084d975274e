"""WARC archives of pages and their capture index, merged from sorted runs."""

from __future__ import annotations

import hashlib
import urllib.parse
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from brightloom.operators.relations import attach
from brightloom.runtime import durable, scratch_path

from .common import forget

#: Compressed bytes after which an archive ends, and captures of a range of the merged index.
ARCHIVE_BYTES, RANGE_ROWS = 16 * 1024 * 1024, 50_000
#: Payloads below this size are always stored.
LEAST_BYTES = 100
#: A digest with more than this part of all rows is joined apart from the others.
HOT_PARTS = 1024
CAPTURE = ("url_key string, captured_at timestamp, page_id long, url string, record_type string, payload_bytes long, "
           "payload_digest string, refers_to long, archive string, offset long, length long")


def _member(record: bytes) -> bytes:
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(record) + squeeze.flush()


#: An empty gzip member, which readers skip: the text sink ends each row with it.
NOTHING = _member(b"")


def url_key(url: str) -> str:
    """Sort key of a URL: host labels reversed, then path and sorted query; scheme, `www.`,
    default port, fragment and case of the host play no part."""
    try:
        parts = urllib.parse.urlsplit(url.strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return url.strip().lower()
    if not host:
        return url.strip().lower()
    labels = ",".join(reversed(host.removeprefix("www.").split(".")))
    place = "" if port in (None, 80, 443) else f":{port}"
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return f"{labels}{place}){parts.path.rstrip('/') or '/'}{'?' + query if query else ''}"


def plan_records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, captured_at: Column | None = None) -> DataFrame:
    """(page_id, url, payload, captured_at, payload_bytes, payload_digest, record_type, refers_to):
    which records hold their payload and which refer to an equal one.

    Repeated digests are aggregated before they meet the pages. Those with more than a
    1,024th of all rows are at most 1,024 and go to every task; the others are joined, so
    no key brings more rows than that part into one task."""
    when = F.timestamp_seconds(F.pmod(F.col(id_col), F.lit(2 ** 32))) if captured_at is None else captured_at.cast("timestamp")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"),
                        F.when((F.year(when) >= 1) & (F.year(when) <= 9999), when).alias("captured_at"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"),
                             "payload_digest": F.sha2(F.col("payload").cast("binary"), 256)})
    counted = rows.select("page_id", "payload_bytes", "payload_digest").groupBy("payload_digest", "payload_bytes").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    total = pages.count()
    owners = durable(counted.where((F.col("n") > 1) & (F.col("payload_bytes") >= LEAST_BYTES)).select("payload_digest", "first_id", "n"))
    often = F.col("n") * HOT_PARTS > total
    hot = owners.where(often).select("payload_digest", F.col("first_id").alias("hot_id"))
    rare = owners.where(~often).select(F.col("payload_digest").alias("joined"), "first_id")
    known = rows.join(F.broadcast(hot), "payload_digest", "left")
    # Rows that have their answer get keys of their own, which match nothing.
    joined = F.when(F.col("hot_id").isNull(), F.col("payload_digest")).otherwise(F.concat(F.lit("#"), F.monotonically_increasing_id()))
    known = known.withColumn("joined", joined).join(rare, "joined", "left")
    first = F.coalesce("hot_id", "first_id")
    other = first.isNotNull() & ~first.eqNullSafe(F.col("page_id"))
    return known.select("page_id", "url", "payload", "captured_at", "payload_bytes", "payload_digest",
                        F.when(other, "revisit").otherwise("response").alias("record_type"), F.when(other, first).alias("refers_to"))


def _lines(pairs: list[tuple[str, str]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in pairs).encode() + b"\r\n"


def _record(row: dict) -> bytes:
    """A record with its header, HTTP response and, unless it is a revisit, payload."""
    http = b"HTTP/1.1 200 OK\r\n" + _lines([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(row["payload_bytes"]))])
    block = http if row["record_type"] == "revisit" else http + row["payload"]
    header = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", _name(row["page_id"]))]
    if row["url"] is not None:
        header.append(("WARC-Target-URI", urllib.parse.quote(row["url"], safe="!#$%&'()*+,/:;=?@[]")))
    if row["captured_at"] is not None:
        header.append(("WARC-Date", row["captured_at"].astimezone(timezone.utc).replace(tzinfo=None).isoformat(timespec="microseconds") + "Z"))
    if row["record_type"] == "revisit":
        header += [("WARC-Refers-To", _name(row["refers_to"])), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    header += [("WARC-Payload-Digest", "sha256:" + row["payload_digest"]), ("Content-Type", "application/http; msgtype=response"),
               ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + _lines(header) + block + b"\r\n\r\n"


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _numbered(name: str) -> int | None:
    digits = name.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def write_archives(records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write the rows of ``plan_records`` below `path`, a gzip member per record, an
    archive's size `archive_bytes` and at most one record more. Each task fills archives
    one after another; Spark's committer moves them into place, so a task that runs twice
    leaves them once."""

    others = [c for c in records.columns if c != "payload"]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for payload, *rest in zip(batch.column("payload").cast(pa.binary()), *(batch.column(c).to_pylist() for c in others), strict=True):
                parts.append(_member(_record(dict(zip(others, rest, strict=True), payload=payload.as_py()))))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], ["content"])
                    parts, size = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], ["content"])

    # The text sink writes a row's bytes as they are; Latin-1 keeps those of the row's end.
    (records.mapInArrow(fill, "content binary").select(F.col("content").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", NOTHING.decode("latin-1")).text(path))


def _members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, data) of each gzip member; one that is cut short is an error."""
    at, view = 0, memoryview(content)
    while at < len(view):
        squeezed, start, data = zlib.decompressobj(31), at, []
        while not squeezed.eof:
            piece = view[at:at + 65_536]
            if not len(piece):
                raise ValueError("archive ends within a record")
            data.append(squeezed.decompress(piece))
            at += len(piece) - len(squeezed.unused_data)
        yield start, at - start, b"".join(data)


def _header(data: bytes) -> tuple[str, dict[str, str], bytes]:
    head, _, block = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    return first, dict(line.split(": ", 1) for line in lines), block


def parse_record(data: bytes) -> dict:
    """The capture that a record holds. A payload that its digest denies is an error."""
    version, header, rest = _header(data)
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    size = int(header["Content-Length"])
    block = rest[:size]
    if len(block) < size:
        raise ValueError("record is shorter than its header says")
    _, http, payload = _header(block)
    digest = header["WARC-Payload-Digest"].removeprefix("sha256:")
    whole = header["WARC-Type"] == "response"
    if whole and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(http["Content-Length"])):
        raise ValueError(f"payload of {header['WARC-Record-ID']} differs from its digest")
    url = header.get("WARC-Target-URI")
    date = header.get("WARC-Date")
    return {"url_key": "" if url is None else url_key(url), "page_id": _numbered(header["WARC-Record-ID"]),
            "captured_at": date and datetime.fromisoformat(date),
            "url": url, "record_type": header["WARC-Type"],
            "payload_bytes": int(http["Content-Length"]), "payload_digest": digest,
            "refers_to": _numbered(header["WARC-Refers-To"]) if "WARC-Refers-To" in header else None, "payload": payload}


def _place(row: dict) -> tuple:
    """Order of the index: key, time, id; missing ones first."""
    return (row["url_key"], row["captured_at"] is not None, row["captured_at"] or 0, row["page_id"] is not None, row["page_id"] or 0)


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all archives below `path`, each archive's rows in index
    order: a sorted run. `offset` and `length` are those of its gzip member."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(CAPTURE))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("archive"), batch.column("content"), strict=True):
                run = []
                for offset, length, data in _members(content.as_py()):
                    if data:
                        row = parse_record(data)
                        del row["payload"]
                        run.append(row | {"archive": name.as_py(), "offset": offset, "length": length})
                run.sort(key=_place)
                yield pa.RecordBatch.from_pylist(run, schema=target)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content").mapInArrow(read, CAPTURE)


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, so the next
    winner is found by one comparison per level."""

    def __init__(self, runs: list[Iterator]):
        self.runs, k = runs, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.losers = [-1] * k
        for leaf in range(k):
            self._climb(leaf)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x, a) < (y, b))

    def _climb(self, winner: int) -> None:
        node = (winner + len(self.runs)) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # first to come here: waits for its match
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while self.runs and self.heads[self.losers[0]] is not None:
            winner = self.losers[0]
            yield self.heads[winner]
            self.heads[winner] = next(self.runs[winner], None)
            self._climb(winner)


def merge_index(captures: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All captures in order of URL key, time and id, with their place in that order from
    0 (`position`) and in the history of their key from 1 (`capture`).

    The runs are cut into ranges of about `range_rows` captures, and each range merges
    its part of every run by a loser tree. Ranges are cut within a key too, so a key of
    any number of captures spreads over as many tasks as it needs. A run of which rows
    came in another order is taken as several."""
    runs = durable(captures)
    ranges = max(1, -(-runs.count() // range_rows))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        whole = pa.Table.from_batches(batches)
        ascending: list[list[tuple]] = []
        last = None
        for at, row in enumerate(whole.select(["url_key", "captured_at", "page_id", "archive"]).to_pylist()):
            key = (*_place(row), at)
            if last is None or (row["archive"], key) < last or row["archive"] != last[0]:
                ascending.append([])
            ascending[-1].append(key)
            last = row["archive"], key
        order, nth, before = [], [], None
        for key in LoserTree([iter(r) for r in ascending]):
            order.append(key[-1])
            nth.append(nth[-1] + 1 if key[0] == before else 1)
            before = key[0]
        out = whole.take(pa.array(order)).append_column("place", pa.array(range(len(order)), pa.int64()))
        yield from out.append_column("nth", pa.array(nth, pa.int64())).combine_chunks().to_batches()

    keyed = runs.repartitionByRange(ranges, "url_key", "captured_at", "page_id")
    merged = durable(keyed.mapInArrow(merge, CAPTURE + ", place long, nth long").withColumn("range", F.spark_partition_id()))
    forget(runs)
    # One row per range: what lies before it, and how much of its first key.
    ends = merged.groupBy("range").agg(F.count(F.lit(1)).alias("rows"), F.min_by("url_key", "place").alias("first_key"),
                                       F.max_by("url_key", "place").alias("last_key"), F.max_by("nth", "place").alias("last_n"))
    order = Window.orderBy("range")
    ends = (ends.withColumn("so_far", F.sum("last_n").over(Window.partitionBy("last_key").orderBy("range")))
            .select("range", F.coalesce(F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                    "first_key", F.when(F.lag("last_key").over(order) == F.col("first_key"), F.lag("so_far").over(order)).alias("carried")))
    carried = F.when(F.col("url_key") == F.col("first_key"), F.coalesce("carried", F.lit(0))).otherwise(F.lit(0))
    return attach(merged, ends, ["range"]).select(
        *[c.split()[0] for c in CAPTURE.split(", ")], (F.col("before") + F.col("place")).alias("position"),
        (F.col("nth") + carried).alias("capture"))


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  captured_at: Column | None = None, path: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a WARC record per page, read the archives back and give their merged index:
    url_key, captured_at, page_id, url, record_type, payload_bytes, payload_digest,
    refers_to, archive, offset, length, position, capture.

    Payloads are the column's bytes (a string's UTF-8), null as empty. Of equal payloads
    of at least 100 bytes, those of the least id hold it and others refer to it; ids that
    are null refer to it too, and hold their payload where no equal one has an id.
    Without `captured_at`, the id modulo 2^32 counts as seconds; dates outside the years
    1 to 9999 count as none. Rows without a URL have an empty key. Repeated rows give a
    capture each, other columns play no part, and an empty table gives an empty index.
    Archives stay below `path` (a new folder of the shared one if None)."""
    path = path or scratch_path(pages.sparkSession, "warc")
    write_archives(plan_records(pages, id_col, url_col, payload_col, captured_at), path, archive_bytes)
    return merge_index(read_captures(pages.sparkSession, path))
