"""WARC archives of pages, and their index as globally ordered capture histories.

Writing: one record per page in text files of the WARC 1.1 format, one file per task. Of
the pages with equal payloads of at least ``least`` bytes, those with the largest id
are stored as responses, the others as revisits that refer to it by record id and keep the
HTTP head (with the payload's length) only. Records are separated by CRLF CRLF as the format
asks. A payload that holds the version line is sent in HTTP chunks cut inside it, so that
the separator with a version line after it is found between records only; files can
be split anywhere when they are read.

Reading: every task parses its records, checks lengths and digests, and writes its captures
as locally sorted runs. The runs are dealt by ranges of (URL key, time, id), each
range small enough for a task; there a loser tree merges the runs of all tasks, reading
the smallest capture of each at a time. Ranges follow each other, so the whole index is in order,
and a URL with very many captures is cut by time.

All tables go through the shared work folder; payloads are never shuffled unless the list of
revisits is too long to broadcast.

Results for odd input: a NULL payload is the empty one, always a response; a NULL URL has the empty
key and sorts first; a NULL id is smaller than all others; rows with the same id and payload are
equal captures, all of them responses if theirs is the largest id; line breaks in URLs are
percent-encoded; an empty table gives an empty index; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.llm.frames import in_batches, partitions
from tabml.session import new_path, staged

VERSION = "WARC/1.1"
_END = "\r\n\r\n"
_BETWEEN = f"{_END}{VERSION}\r\n"
_SMALL = 200_000  # revisits that may be broadcast: about 50 bytes each
_RANGE_ROWS = 200_000  # captures that one task merges
CAPTURE = [
    ("url_key", pa.string()),
    ("captured", pa.int64()),
    ("page_id", pa.int64()),
    ("url", pa.string()),
    ("record_type", pa.string()),
    ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()),
    ("intact", pa.bool_()),
    ("archive", pa.string()),
]
_DDL = (
    "url_key string, captured long, page_id long, url string, record_type string, refers_to long,"
    " payload_bytes long, payload_digest string, intact boolean, archive string"
)


# ---------------------------------------------------------------- writing


def _chunked(payload: Column) -> Column:
    """The payload in HTTP chunks, cut wherever the version line would appear."""
    parts = F.split(payload, "(?<=WARC)(?=/1[.]1)")
    chunk = lambda p: F.concat(F.hex(F.octet_length(p).cast("long")), F.lit("\r\n"), p, F.lit("\r\n"))
    return F.concat(F.array_join(F.transform(parts, chunk), ""), F.lit("0\r\n\r\n"))


def _record(url: Column, page: Column, captured: Column, payload: Column, digest: Column, refers: Column) -> Column:
    """A record without its version line's place in the file: version line, heads, body."""
    revisit = refers.isNotNull()
    cut = F.contains(payload, F.lit(VERSION))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(payload).cast("string"),
        F.when(cut & ~revisit, F.lit("\r\nTransfer-Encoding: chunked")).otherwise(F.lit("")),
        F.lit(_END),
    )
    body = F.when(revisit, F.lit("")).when(cut, _chunked(payload)).otherwise(payload)
    block = F.concat(head, body)
    line = lambda name, value: F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))
    safe = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    same = F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))),
        line("WARC-Target-URI", safe),
        line("WARC-Date", F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), refers.cast("string"), F.lit(">")))),
        line("WARC-Profile", F.when(revisit, same)),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(_END),
        block,
    )


def write_archives(
    pages: DataFrame,
    captured: Column,
    path: str | None = None,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = 1000,
) -> str:
    """Write one record per page (whole-number key); returns the folder. ``captured``: a UTC timestamp."""
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    rows = pages.select(
        F.col(key).cast("long").alias("page"),
        F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null")).alias("row"),
        F.col(url).alias("url"),
        captured.alias("captured"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha1(F.encode("payload", "UTF-8")))
    stored = staged(rows.select("page", "row", "digest", F.octet_length("payload").alias("n")), "payload-digests")
    large = stored.filter(F.col("n") >= least)
    groups = large.groupBy("digest").agg(F.max("page").alias("refers"), F.count(F.lit(1)).alias("copies"))
    copies = groups.filter("copies > 1").select("digest", "refers")
    again = large.join(copies, "digest").filter(F.coalesce(F.col("page") != F.col("refers"), F.col("refers").isNotNull()))
    again = staged(again.select("row", "digest", "refers").distinct(), "revisits")
    if again.count() <= _SMALL:
        again = F.broadcast(again)
    told = rows.join(again, ["row", "digest"], "left")
    record = _record(*[F.col(c) for c in ("url", "page", "captured", "payload", "digest", "refers")])
    told.select(record.alias("value")).write.option("lineSep", _END).text(path)
    return path


# ---------------------------------------------------------------- reading


def _dechunked(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end], 16)
        if not size:
            return b"".join(parts)
        parts.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def _fields(head: bytes) -> dict[str, str]:
    lines = (line.partition(b":") for line in head.split(b"\r\n"))
    return {name.strip().lower().decode(): value.strip().decode() for name, _, value in lines if value}


def _id(text: str | None) -> int | None:
    digits = (text or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def url_key(url: str | None) -> str:
    """Host labels from right to left, then the path: pages of a host stand together."""
    if not url:
        return ""
    rest = url.partition("://")[2] or url
    host, slash, path = rest.partition("/")
    host = host.rpartition("@")[2].partition(":")[0].lower().removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")/" + path.partition("#")[0].lower()


def parsed(record: bytes) -> tuple[dict, bytes]:
    """Capture and payload of one record; ``intact`` tells whether length and digest agree."""
    head, _, block = record.removeprefix(f"{VERSION}\r\n".encode()).partition(_END.encode())
    fields = _fields(head)
    size = int(fields["content-length"])
    whole = len(block) >= size
    http, _, body = block[:size].partition(_END.encode())
    told = _fields(http.partition(b"\r\n")[2])
    if told.get("transfer-encoding") == "chunked":
        body = _dechunked(body)
    kind, length = fields["warc-type"], int(told["content-length"])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        whole &= len(body) == length and hashlib.sha1(body).hexdigest() == digest
    date = np.datetime64(fields["warc-date"].removesuffix("Z"), "s").astype(int) if "warc-date" in fields else None
    url = fields.get("warc-target-uri")
    capture = {
        "url_key": url_key(url),
        "captured": date,
        "page_id": _id(fields["warc-record-id"]),
        "url": url,
        "record_type": kind,
        "refers_to": _id(fields.get("warc-refers-to")),
        "payload_bytes": length,
        "payload_digest": digest,
        "intact": whole,
    }
    return capture, body


def _order(capture: dict) -> tuple:
    low = -(1 << 63)
    when, page = capture["captured"], capture["page_id"]
    return capture["url_key"].encode(), low if when is None else when, low if page is None else page, capture["payload_digest"]


def _batch(captures: list[dict], extra: tuple = ()) -> pa.RecordBatch:
    columns = [pa.array([c[name] for c in captures], kind) for name, kind in CAPTURE]
    columns += [pa.array(values, kind) for _, kind, values in extra]
    return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in CAPTURE] + [n for n, _, _ in extra])


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives in locally sorted runs: CAPTURE, ``run`` and ``place`` in it."""
    lines = spark.read.option("lineSep", _BETWEEN).text(path)
    lines = lines.select("value", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("archive"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            archives, found = batch.column("archive").to_pylist(), []
            for archive, value in zip(archives, batch.column("value")):
                found.append(parsed(value.as_py().encode())[0] | {"archive": archive})
            found.sort(key=_order)
            run, place = [part * (1 << 24) + number] * len(found), list(range(len(found)))
            yield _batch(found, (("run", pa.int64(), run), ("place", pa.int64(), place)))

    return in_batches(lines.filter("value <> ''"), runs, f"{_DDL}, run long, place long")


class LoserTree:
    """Merges sorted iterators: each inner node keeps the loser of its match, the root the winner."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs, k = runs, max(len(runs), 1)
        self.heads = [next(r, None) for r in runs] or [None]
        self.k, self.tree = k, [-1] * k
        winner = [-1] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winner[2 * node], winner[2 * node + 1]
            winner[node], self.tree[node] = (a, b) if self._before(a, b) else (b, a)
        self.tree[0] = winner[1] if k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or x is not None and (x, a) <= (y, b)

    def __iter__(self) -> Iterator[tuple]:
        while (head := self.heads[self.tree[0]]) is not None:
            yield head
            winner = self.tree[0]
            self.heads[winner] = next(self.runs[winner], None)
            node = (winner + self.k) // 2
            while node:
                if self._before(self.tree[node], winner):
                    self.tree[node], winner = winner, self.tree[node]
                node //= 2
            self.tree[0] = winner


def merged_index(runs: DataFrame) -> DataFrame:
    """All captures in order of URL key, time and id, merged range by range from the sorted runs."""
    runs = staged(runs, "capture-runs")
    ranges = max(partitions(runs.sparkSession), -(-runs.count() // _RANGE_ROWS))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The captures of one range, a bounded number: each run's part as a list in its order.
        parts: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                parts.setdefault(row["run"], []).append(row)
        order = [iter([(_order(r), r["place"], run, r) for r in rows]) for run, rows in sorted(parts.items())]
        out = []
        for *_, row in LoserTree(order):
            out.append(row)
            if len(out) == 5000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    # Down to the place in the run, so that captures which agree in all else are several ranges as well.
    keys = [F.col(c) for c in ("url_key", "captured", "page_id", "payload_digest", "place", "run")]
    dealt = runs.repartitionByRange(ranges, *keys)
    return dealt.sortWithinPartitions("run", "place").mapInArrow(merge, _DDL)


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload) of the response records."""
    lines = spark.read.option("lineSep", _BETWEEN).text(path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parsed(v.as_py().encode()) for v in batch.column("value")]
            kept = [(c["page_id"], body.decode()) for c, body in found if c["record_type"] == "response"]
            columns = [pa.array([k for k, _ in kept], pa.int64()), pa.array([b for _, b in kept], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "payload"])

    return in_batches(lines.filter("value <> ''"), read, "page_id long, payload string")
