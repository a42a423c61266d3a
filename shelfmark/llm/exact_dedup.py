"""Exact deduplication by Grace hashing.

Texts are equal when they are identical after lower-casing A-Z; null counts as
the empty text. Each task first drops the copies among its own rows, so that of
a text with any number of copies at most one row per task is shuffled. The rows
are then dealt by the SHA-256 of the text, and each task does the same again.

Both times a task puts its records into an open-addressing table that compares
complete contents. What outgrows the memory given is partitioned by hash to
spill files, each of which is treated alike, with the next byte of the hash.
Spill files belong to the running task and go with it; a lost executor's tasks
start over from the shuffle or the source.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import ascii_lower, free_name, give_back_memory, row_hash, stored

MEMORY_BYTES = 64 << 20
SLICE_BYTES = 4 << 20
FAN_OUT = 16
KEY, COPIES, TIES = "content_key", "copies", "ties"


class ContentTable:
    """Open addressing with linear probing over distinct contents.

    Keeps of equal contents the row with the largest (rank, tie); ``copies``
    counts all rows, ``ties`` those that share the largest rank. A null rank is
    below all others.
    """

    def __init__(self, text: str):
        self.text = text
        self.slots = np.full(1 << 10, -1, dtype=np.int64)
        self.hashes: list[int] = []
        self.keys: list[bytes] = []
        self.best: list[tuple] = []
        self.copies: list[int] = []
        self.ties: list[int] = []
        self.where: list[tuple[int, int]] = []
        self.rows: list[pa.RecordBatch] = []
        self.bytes = 0

    def __len__(self) -> int:
        return len(self.hashes)

    def _content(self, entry: int) -> bytes:
        batch, row = self.where[entry]
        return _normalised(self.rows[batch].column(self.text)[row].as_py())

    def _find(self, digest: int, content: bytes, fresh: dict[int, bytes]) -> tuple[int, int]:
        """The slot that the content has or would have, and its entry or -1."""
        mask = len(self.slots) - 1
        at = digest & mask
        while (entry := int(self.slots[at])) >= 0:
            if self.hashes[entry] == digest:
                known = fresh[entry] if entry in fresh else self._content(entry)
                if known == content:
                    return at, entry
            at = (at + 1) & mask
        return at, -1

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, dtype=np.int64)
        mask = len(self.slots) - 1
        for entry, digest in enumerate(self.hashes):
            at = digest & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry

    def add(self, batch: pa.RecordBatch, contents, keys, ranks, ties, copies, tied) -> None:
        winners: dict[int, int] = {}
        fresh: dict[int, bytes] = {}
        for row, content in enumerate(contents):
            digest = int.from_bytes(keys[row][-8:], "little") >> 1
            order = (ranks[row] is not None, ranks[row] or 0, ties[row])
            at, entry = self._find(digest, content, fresh)
            if entry < 0:
                entry = len(self.hashes)
                self.slots[at] = entry
                self.hashes.append(digest)
                self.keys.append(keys[row])
                self.best.append(order)
                self.copies.append(copies[row])
                self.ties.append(tied[row])
                self.where.append((-1, -1))
                self.bytes += 300
                winners[entry], fresh[entry] = row, content
                if 2 * len(self.hashes) > len(self.slots):
                    self._grow()
                continue
            self.copies[entry] += copies[row]
            if order[:2] == self.best[entry][:2]:
                self.ties[entry] += tied[row]
            elif order > self.best[entry]:
                self.ties[entry] = tied[row]
            if order > self.best[entry]:
                self.best[entry] = order
                winners[entry], fresh[entry] = row, content
        if winners:
            kept = batch.take(pa.array(list(winners.values()), pa.int64()))
            for place, entry in enumerate(winners):
                self.where[entry] = (len(self.rows), place)
            self.rows.append(kept)
            self.bytes += kept.nbytes

    def compact(self) -> None:
        """Gives up the rows that better ones have replaced, and counts the bytes again."""
        by_batch: list[list[int]] = [[] for _ in self.rows]
        for entry, (batch, _) in enumerate(self.where):
            by_batch[batch].append(entry)
        rows, self.rows = self.rows, []
        self.bytes = 300 * len(self.hashes)
        for number, entries in enumerate(by_batch):
            batch, rows[number] = rows[number], None
            if not entries:
                continue
            if len(entries) < batch.num_rows:
                batch = batch.take(pa.array([self.where[e][1] for e in entries], pa.int64()))
                for place, entry in enumerate(entries):
                    self.where[entry] = (len(self.rows), place)
            else:
                for entry in entries:
                    self.where[entry] = (len(self.rows), self.where[entry][1])
            self.rows.append(batch)
            self.bytes += batch.nbytes

    def result(self) -> Iterator[pa.RecordBatch]:
        """The row kept of each content, its columns followed by key, copies and ties."""
        by_batch: list[list[int]] = [[] for _ in self.rows]
        for entry, (batch, _) in enumerate(self.where):
            by_batch[batch].append(entry)
        for number, entries in enumerate(by_batch):
            rows, self.rows[number] = self.rows[number], None
            if not entries:
                continue
            live = rows.take(pa.array([self.where[e][1] for e in entries], pa.int64()))
            arrays = [
                *live.columns,
                pa.array([self.keys[e] for e in entries], pa.binary()),
                pa.array([self.copies[e] for e in entries], pa.int64()),
                pa.array([self.ties[e] for e in entries], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [*live.schema.names, KEY, COPIES, TIES])


def _normalised(text: str | None) -> bytes:
    return b"" if text is None else text.encode().lower()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut to about SLICE_BYTES."""
    for batch in batches:
        rows = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _prepared(batch: pa.RecordBatch, text: str, rank: str, tie: str):
    """The batch without its working columns, and what the table asks of each row."""
    texts = batch.column(text).to_pylist()
    contents = [_normalised(t) for t in texts]
    if KEY in batch.schema.names:
        keys = batch.column(KEY).to_pylist()
        copies, tied = batch.column(COPIES).to_pylist(), batch.column(TIES).to_pylist()
        batch = batch.drop_columns([KEY, COPIES, TIES])
    else:
        keys = [hashlib.sha256(c).digest() for c in contents]
        copies = tied = [1] * len(contents)
    ranks, ties = batch.column(rank).to_pylist(), batch.column(tie).to_pylist()
    return batch, contents, keys, ranks, ties, copies, tied


def grace_distinct(
    batches: Iterator[pa.RecordBatch], text: str, rank: str, tie: str,
    memory: int = MEMORY_BYTES, depth: int = 0,
) -> Iterator[pa.RecordBatch]:
    """The row kept of each content among ``batches``, with key, copies and ties."""
    table = ContentTable(text)
    folder, files = None, {}
    try:
        for batch in _slices(batches):
            if folder is not None:
                _spill(batch, text, rank, tie, depth, folder.name, files)
                continue
            table.add(*_prepared(batch, text, rank, tie))
            compacted = table.bytes > memory
            if compacted:
                table.compact()
            # Half, so that a table isn't compacted again for every few rows.
            if 2 * table.bytes > memory and compacted and len(table) > 1 and depth < 31:
                folder = tempfile.TemporaryDirectory(prefix="grace-")
                for kept in table.result():
                    _spill(kept, text, rank, tie, depth, folder.name, files)
                table = None
        if folder is None:
            yield from table.result()
            return
        buckets = sorted(files)
        _close(files)
        for bucket in buckets:
            path = os.path.join(folder.name, str(bucket))
            with pa.OSFile(path) as source, pa.ipc.open_stream(source) as reader:
                yield from grace_distinct(iter(reader), text, rank, tie, memory, depth + 1)
            os.remove(path)
    finally:
        if folder is not None:
            _close(files)
            folder.cleanup()


def _close(files: dict) -> None:
    while files:
        _, (writer, sink) = files.popitem()
        writer.close()
        sink.close()


def _spill(batch, text, rank, tie, depth, folder, files) -> None:
    if KEY not in batch.schema.names:
        batch, contents, keys, _, _, copies, tied = _prepared(batch, text, rank, tie)
        arrays = [*batch.columns, pa.array(keys, pa.binary()), pa.array(copies, pa.int64()), pa.array(tied, pa.int64())]
        batch = pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, KEY, COPIES, TIES])
    else:
        # What the shuffle brings says that columns hold no nulls, what the table gives does not; a file has one schema.
        batch = pa.RecordBatch.from_arrays(batch.columns, batch.schema.names)
    buckets = np.array([k[depth] % FAN_OUT for k in batch.column(KEY).to_pylist()])
    for bucket in np.unique(buckets).tolist():
        part = batch.take(pa.array(np.flatnonzero(buckets == bucket)))
        if bucket not in files:
            sink = pa.OSFile(os.path.join(folder, str(bucket)), "wb")
            files[bucket] = (pa.ipc.new_stream(sink, part.schema), sink)
        files[bucket][0].write_batch(part)


def distinct_rows(df: DataFrame, text: str, rank: str, tie: str, memory: int = MEMORY_BYTES) -> DataFrame:
    """One row per content: ``df``'s columns, then content_key, copies and ties."""
    schema = T.StructType(
        [
            *df.schema,
            T.StructField(KEY, T.BinaryType()),
            T.StructField(COPIES, T.LongType()),
            T.StructField(TIES, T.LongType()),
        ]
    )

    def distinct(batches):
        yield from grace_distinct(batches, text, rank, tie, memory)
        give_back_memory()

    return df.mapInArrow(distinct, schema).repartition(KEY).mapInArrow(distinct, schema)


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without copies, all columns kept; of equal texts the largest id stays.

    Null text is the empty text. A null id is below all others. Of rows that
    share text and id one stays, by a hash over all columns. No rows: no rows.
    Ids are whole numbers.
    """
    rank, tie, whole = (free_name(docs, n) for n in ("rank", "tie", "whole"))
    content = free_name(docs, "content")
    rows = docs.select(
        F.col(text).alias(content),
        F.col(doc_id).cast("long").alias(rank),
        row_hash(docs).alias(tie),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias(whole),
    )
    kept = distinct_rows(rows, content, rank, tie)
    return kept.select(
        *[
            F.col(content).alias(text) if c == text else F.col(f"{whole}.`{c}`").alias(c)
            for c in docs.columns
        ]
    )


def duplicate_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The classes come from the Grace hash tables, one row each. The documents
    meet them by the SHA-256 of their text, in one join of two written tables, so
    that Spark can split it where one class holds many rows. Null text is the
    empty text; a null id is below all others, and keep_id is null where no copy
    has an id. Where rows share text and the largest id, exactly one of them is
    marked as kept. No rows: no rows.
    """
    rows = docs.select(
        F.col(text).alias("content"), F.col(doc_id).cast("long").alias("rank"), F.lit(0).cast("long").alias("tie")
    )
    classes = stored(
        distinct_rows(rows, "content", "rank", "tie").select(
            KEY, F.col("rank").alias("keep_id"), F.col(COPIES).alias("group_size"), TIES
        ),
        "dedup-classes",
    )
    digest = F.sha2(ascii_lower(F.coalesce(F.col(text), F.lit(""))).cast("binary"), 256)
    members = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(doc_id).alias("doc_id"),
            F.unhex(digest).alias(KEY),
        ),
        "dedup-members",
    )
    # Which row stays where several have the largest id: found among those rows, then part of the class.
    tied = classes.where(F.col(TIES) > 1).select(KEY, "keep_id")
    best = stored(
        members.join(tied, KEY).where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(KEY, "row"), "dedup-tied"
    )
    first = best.groupBy(KEY).agg(F.min("row").alias("first_row"))
    whole = stored(classes.join(first, KEY, "left").select(KEY, "keep_id", "group_size", "first_row"), "dedup-whole")
    return members.join(whole, KEY).select(
        "doc_id",
        "keep_id",
        "group_size",
        (
            F.col("doc_id").eqNullSafe(F.col("keep_id"))
            & F.coalesce(F.col("row") == F.col("first_row"), F.lit(True))
        ).alias("kept"),
        F.lower(F.hex(KEY)).alias("text_sha256"),
    )
