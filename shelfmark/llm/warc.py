"""WARC archives of pages, and their capture index by external merge.

Writing: of pages with equal payloads one becomes a response record, the others
revisit records that name it and hold no payload. A task sorts its captures by
URL key and time, writes them to archive files of its own, one gzip member per
record, and returns the index of what it wrote, a locally sorted run.

Index: the runs are dealt by ranges of (URL key, time, page id), so the captures
of one URL may be shared by several tasks. A task gets pieces of many runs,
spills what outgrows its memory, and merges them with a loser tree, in passes if
there are very many. The ranges one after the other are the capture histories in
global order.

Reading: the index is dealt by archive file, and each record is read from its
place and checked against its digest.

Archives are written below the shared folder, through the file system that its
URI names. Each attempt of a task writes files of its own name, and only those
of the attempt that succeeded are in the index, so lost executors leave nothing
that is read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import tempfile
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import stored
from shelfmark.session import scratch_dir

FILE_BYTES = 64 << 20
RUN_ROWS = 200_000
FAN_IN = 64
GZIP_LEVEL = 1
RESPONSE, REVISIT = "response", "revisit"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = T.StructType(
    [
        T.StructField("url_key", T.StringType()),
        T.StructField("captured", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
    ]
)


def url_key(url: Column) -> Column:
    """The host's labels from the last, a bracket, the path: sorts a site's pages together."""
    url = F.coalesce(url, F.lit(""))
    prefix = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://)?(?:[^/?#@]*@)?(?:[Ww]{3}\d*\.)?([^/?#]*)"
    host = F.lower(F.regexp_extract(url, prefix, 1))
    rest = F.regexp_replace(F.regexp_replace(url, prefix, ""), "#.*$", "")
    labels = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.concat(labels, F.lit(")"), F.when(rest == "", F.lit("/")).otherwise(rest))


def capture_records(pages: DataFrame, captured: Column, least_bytes: int = 0) -> DataFrame:
    """A row per record to write; only responses carry the html.

    Of pages with equal payloads of at least ``least_bytes`` the one with the
    largest page id, then URL, is the response. Copies of a payload are dropped
    below the shuffle, so a payload shared by very many pages is sent once per
    task; revisits come from ids, URLs and digests alone, which are written, as
    are the first of each payload: Spark can split the join of the two where one
    payload has very many revisits.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    seen = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
        F.sha2(payload, 256).alias("content"),
        F.sha1(payload).alias("sha1"),
        F.octet_length(payload).cast("long").alias("bytes"),
        captured.alias("captured"),
    )
    large = seen if least_bytes <= 0 else seen.where(F.col("bytes") >= least_bytes)
    responses = large.groupBy("content", "sha1", "bytes").agg(
        F.max(F.struct("page_id", "url", "captured", "html")).alias("r")
    )
    members = stored(
        large.groupBy("content", "sha1", "bytes", "page_id", "url", "captured").agg(F.count("*").alias("n")),
        "warc-members",
    )
    firsts = stored(
        members.groupBy("content")
        .agg(F.max(F.struct("page_id", "url", "captured")).alias("r"), F.sum("n").alias("size"))
        .where("size > 1"),
        "warc-firsts",
    )
    is_first = (
        F.col("page_id").eqNullSafe(F.col("r.page_id"))
        & F.col("url").eqNullSafe(F.col("r.url"))
        & F.col("captured").eqNullSafe(F.col("r.captured"))
    )
    revisits = (
        members.join(firsts, "content")
        .withColumn("times", F.col("n") - F.when(is_first, 1).otherwise(0))
        .where("times > 0")
        .select(
            "page_id", "url", "captured", "sha1", "bytes", F.lit(None).cast("string").alias("html"),
            F.lit(REVISIT).alias("record_type"), F.col("r.page_id").alias("refers_to"), F.col("r.url").alias("refers_url"),
            F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy"),
        )
        .drop("copy")
    )
    none = (F.lit(None).cast("long").alias("refers_to"), F.lit(None).cast("string").alias("refers_url"))
    records = responses.select(
        "r.page_id", "r.url", "r.captured", "sha1", "bytes", "r.html", F.lit(RESPONSE).alias("record_type"), *none
    ).unionByName(revisits)
    if least_bytes > 0:
        small = seen.where(F.col("bytes") < least_bytes)
        records = records.unionByName(
            small.select("page_id", "url", "captured", "sha1", "bytes", "html", F.lit(RESPONSE).alias("record_type"), *none)
        )
    return records


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _uri(url: str | None) -> str:
    return quote(url or "", safe="%!#$&'()*+,/:;=?@[]~-._")


def record_bytes(row: dict) -> bytes:
    """One record, uncompressed."""
    payload = b"" if row["html"] is None else row["html"].encode()
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    stamp = row["captured"]
    date = f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}T{stamp[8:10]}:{stamp[10:12]}:{stamp[12:14]}Z"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n"
    block = http.encode() + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {_urn(row['page_id'])}",
        f"WARC-Target-URI: {_uri(row['url'])}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if row["record_type"] == REVISIT:
        head += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {_urn(row['refers_to'])}",
            f"WARC-Refers-To-Target-URI: {_uri(row['refers_url'])}",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(records: DataFrame, folder: str, level: int = GZIP_LEVEL) -> DataFrame:
    """Writes the records below ``folder``; returns the index runs, stored."""
    ordered = records.withColumn("url_key", url_key(F.col("url"))).sortWithinPartitions("url_key", "captured", "page_id")

    def write(batches):
        system, root = pa.fs.FileSystem.from_uri(folder)
        out = name = None
        offset = 0
        try:
            for batch in batches:
                lines = []
                for row in batch.to_pylist():
                    if out is None:
                        system.create_dir(root, recursive=True)
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{root}/{name}", compression=None)
                    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = pack.compress(record_bytes(row)) + pack.flush()
                    out.write(member)
                    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                    lines.append(
                        (row["url_key"], row["captured"], row["page_id"], row["record_type"], digest, name, offset, len(member))
                    )
                    offset += len(member)
                    if offset >= FILE_BYTES:
                        out.close()
                        out = None
                if lines:
                    yield _batch(lines)
        finally:
            if out is not None:
                out.close()

    return stored(ordered.mapInArrow(write, INDEX), "index-runs")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64() if isinstance(f.dataType, T.LongType) else pa.string() for f in INDEX]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], INDEX.names)


def _key(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0, row[5], row[6]


class LoserTree:
    """Merges sorted streams: each inner node holds the loser of its match, the winner goes up."""

    def __init__(self, streams: list[Iterator[tuple]]):
        self.streams = streams
        self.leaves = max(1, len(streams))
        self.heads: list = [self._pull(i) for i in range(len(streams))]
        self.losers = [-1] * self.leaves
        self.winner = self._build(1) if streams else -1

    def _pull(self, stream: int):
        row = next(self.streams[stream], None)
        return None if row is None else (_key(row), row)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x[0] < y[0] or (x[0] == y[0] and a < b)

    def _build(self, node: int) -> int:
        if node >= self.leaves:
            return node - self.leaves
        a, b = self._build(2 * node), self._build(2 * node + 1)
        winner, loser = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = loser
        return winner

    def __iter__(self) -> Iterator[tuple]:
        while self.winner >= 0 and self.heads[self.winner] is not None:
            won = self.winner
            yield self.heads[won][1]
            self.heads[won] = self._pull(won)
            node = (won + self.leaves) // 2
            while node:
                if self._beats(self.losers[node], won):
                    self.losers[node], won = won, self.losers[node]
                node //= 2
            self.winner = won


def _from_file(path: str) -> Iterator[tuple]:
    with pa.OSFile(path) as source, pa.ipc.open_stream(source) as reader:
        for batch in reader:
            yield from zip(*[c.to_pylist() for c in batch.columns])
    os.remove(path)


def _to_file(rows: Iterable[tuple], path: str) -> str:
    sink, writer, some = pa.OSFile(path, "wb"), None, []

    def flush():
        nonlocal writer
        batch = _batch(some)
        writer = writer or pa.ipc.new_stream(sink, batch.schema)
        writer.write_batch(batch)
        some.clear()

    for row in rows:
        some.append(row)
        if len(some) >= 10_000:
            flush()
    if some:
        flush()
    writer.close()
    sink.close()
    return path


def merged_runs(batches: Iterable[pa.RecordBatch], run_rows: int = RUN_ROWS, fan_in: int = FAN_IN) -> Iterator[tuple]:
    """The rows of all batches in order: rising runs are found, spilled if need be, and merged."""
    with tempfile.TemporaryDirectory(prefix="runs-") as folder:
        runs: list[list[tuple]] = []
        files: list[str] = []
        held = 0
        for batch in batches:
            rows = list(zip(*[c.to_pylist() for c in batch.columns]))
            rows.sort(key=_key)  # linear where they are in order
            if not rows:
                continue
            if runs and _key(runs[-1][-1]) <= _key(rows[0]):
                runs[-1].extend(rows)
            else:
                runs.append(rows)
            held += len(rows)
            if held >= run_rows:
                files += [_to_file(r, f"{folder}/{uuid.uuid4().hex}") for r in runs]
                runs, held = [], 0
        while len(files) + len(runs) > fan_in:
            if len(files) < 2:
                files += [_to_file(r, f"{folder}/{uuid.uuid4().hex}") for r in runs]
                runs = []
            some, files = files[:fan_in], files[fan_in:]
            files.append(_to_file(LoserTree([_from_file(f) for f in some]), f"{folder}/{uuid.uuid4().hex}"))
        yield from LoserTree([*map(_from_file, files), *map(iter, runs)])


def merge_index(runs: DataFrame) -> DataFrame:
    """The capture index in global order of URL key, time and page id, stored part by part."""

    def merge(batches):
        some = []
        for row in merged_runs(batches):
            some.append(row)
            if len(some) >= 10_000:
                yield _batch(some)
                some = []
        if some:
            yield _batch(some)

    ranged = runs.repartitionByRange("url_key", "captured", "page_id")
    return stored(ranged.mapInArrow(merge, INDEX), "index")


def parsed_record(data: bytes) -> dict:
    """The fields of one uncompressed record; fails where payload and digest differ."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: ")).split(": ")[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == RESPONSE:
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    ids = [fields.get(n, "<urn:x-page:>")[12:-1] for n in ("WARC-Record-ID", "WARC-Refers-To")]
    own, other = [int(i) if i else None for i in ids]
    return {
        "page_id": own, "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"],
        "refers_to": other, "url": fields["WARC-Target-URI"], "payload": payload,
    }


READ = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("url_key", T.StringType()),
        T.StructField("captured", T.StringType()),
    ]
)


def read_archives(index: DataFrame, folder: str, payload: bool = False) -> DataFrame:
    """What the records at the index's places say; with ``payload`` also their bytes."""
    schema = T.StructType([*READ, T.StructField("payload", T.BinaryType())]) if payload else READ
    placed = index.repartition("file").sortWithinPartitions("file", "offset")

    def read(batches):
        system, root = pa.fs.FileSystem.from_uri(folder)
        name = source = None
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        try:
            for batch in batches:
                rows, held = [], 0
                for line in batch.to_pylist():
                    if line["file"] != name:
                        if source is not None:
                            source.close()
                        name = line["file"]
                        source = system.open_input_file(f"{root}/{name}")
                    source.seek(line["offset"])
                    found = parsed_record(zlib.decompress(source.read(line["length"]), 31))
                    found |= {"url_key": line["url_key"], "captured": line["captured"]}
                    rows.append(tuple(found[f] for f in schema.names))
                    held += found["payload_bytes"] if payload else 100
                    if held > 16 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema.names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema.names)
        finally:
            if source is not None:
                source.close()

    return placed.mapInArrow(read, schema)


def archived(pages: DataFrame, captured: Column | None = None, least_bytes: int = 0) -> DataFrame:
    """Writes a record per page, merges the index, reads the archives back by it.

    Columns page_id, payload_bytes, payload_digest, record_type, refers_to,
    url_key, captured. Null html is an empty payload, a null url an empty one; a
    null page id is below all others. Repeated rows are captures of their own.
    Without ``captured`` (text of 14 digits) the time is made from the page id. No
    rows: no rows.
    """
    if captured is None:
        seconds = 1_600_000_000 + F.pmod(F.coalesce(F.col("page_id").cast("long"), F.lit(0)), F.lit(1 << 30))
        captured = F.date_format(F.timestamp_seconds(seconds), "yyyyMMddHHmmss")
    folder = scratch_dir(pages.sparkSession, "warc")
    runs = write_archives(capture_records(pages, captured, least_bytes), folder)
    return read_archives(merge_index(runs), folder)
