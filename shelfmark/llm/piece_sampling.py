"""SentencePiece encoding by forward filtering and backward sampling, and decoding.

The pieces of a given model span a lattice over a text. A path's weight is the
product of its pieces' weights, exp(theta x score) with the model's scores.
Forward filtering sums the weights of all paths to each place; backward sampling
then draws pieces from the end with the probabilities that the sums give, so
whole segmentations are drawn exactly by their weight. The draws come from a
hash of seed, row key and place: a row's segmentation never depends on the other
rows, the partitions or a second run.

No piece holds a space after another character, so the lattice falls into
independent parts, words with their leading spaces. Each distinct word's lattice
is built once per task, and all its occurrences are drawn together in numpy.

A character without a piece becomes the pieces of its UTF-8 bytes, as does a
literal U+2581, which the model would read as a space. So decoding gives back
every text exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import free_name, give_back_memory

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
THETA = 1 / 2000
SEED = 1
WORDS_KEPT = 250_000
# Lattices are built for so many new words together.
WORDS_AT_ONCE = 8_000
BYTES_AT_ONCE = 1_000_000
# Piece scores below this are placeholders, not ranks.
LOWEST_SCORE = -1e6
SPACE = "▁"


class PieceLattices:
    """The lattices of the words seen so far, as flat arrays of nodes and arcs.

    Node k is a place in a word, after one of its characters, or between the
    bytes of one. Its arcs lead back to earlier places; they are numbered
    consecutively from ``first[k]`` and carry their cumulated probability, the
    last one 1.
    """

    def __init__(self, model: bytes, theta: float = THETA):
        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces: dict[str, int] = {}
        self.bytes = np.zeros(256, np.int32)
        self.text: list[bytes] = []
        self.weight = np.zeros(processor.get_piece_size())
        for i in range(processor.get_piece_size()):
            piece, score = processor.id_to_piece(i), processor.get_score(i)
            if processor.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.text.append(bytes([int(piece[3:5], 16)]))
            elif processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i):
                self.text.append(b"")
            else:
                plain = piece.replace(SPACE, " ")
                self.text.append(plain.encode())
                pieces[plain] = i
                self.weight[i] = theta * (score if score > LOWEST_SCORE else -i)
        # A byte counts as much as the rarest piece.
        self.byte_weight = self.weight.min()
        if any(re.search("[^ ] ", p) for p in pieces):
            raise ValueError("a piece goes over the start of a word; the lattice does not fall into words")
        alone = "\n" if not any("\n" in p for p in pieces) else ""
        self.parts = re.compile(f" +[^ {alone}]*|[^ {alone}]+" + ("|\n" if alone else "")).findall
        self._build_trie(pieces)
        self.clear()

    def _build_trie(self, pieces: dict[str, int]) -> None:
        """The pieces' prefixes as states; a step is a state and a character."""
        steps: dict[int, int] = {}
        ends = [-1]
        for piece, i in pieces.items():
            state = 0
            for c in piece:
                step = state << 21 | ord(c)
                if step not in steps:
                    steps[step] = len(ends)
                    ends.append(-1)
                state = steps[step]
            ends[state] = i
        order = sorted(steps)
        self.steps = np.array(order, np.int64)
        self.after = np.array([steps[k] for k in order], np.int64)
        self.ends = np.array(ends, np.int32)
        self.longest = max(map(len, pieces))

    def clear(self) -> None:
        self.words: dict[str, int] = defaultdict(count().__next__)  # numbered as they come
        self.last = np.zeros(0, np.int32)
        self.first = np.zeros(0, np.int32)
        self.reach, self.back = np.zeros(0, np.float32), np.zeros(0, np.int32)
        self.piece = np.zeros(0, np.int32)

    def _pieces_in(self, codes: np.ndarray, limit: np.ndarray):
        """(start, length, piece) of every piece in the words; ``limit`` is where a character's word ends."""
        start, state = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        found = []
        for length in range(1, self.longest + 1):
            inside = start + length <= limit[start]
            start, state = start[inside], state[inside]
            step = state << 21 | codes[start + length - 1]
            at = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
            there = self.steps[at] == step
            start, state = start[there], self.after[at[there]]
            piece = self.ends[state]
            ends = piece >= 0
            found.append((start[ends], np.full(int(ends.sum()), length), piece[ends]))
            if not len(start):
                break
        return [np.concatenate(c) for c in zip(*found)]

    def add(self, words: list[str]) -> None:
        """Builds the lattices of new words: forward sums place by place, then the arcs' shares."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.array([len(w) for w in words], np.int64)
        limit = np.repeat(np.cumsum(sizes), sizes)
        begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
        start, length, piece = self._pieces_in(codes, limit)
        # Characters without a piece of their own: the pieces of their bytes, a chain with one arc per node.
        known = np.zeros(len(codes), bool)
        known[start[length == 1]] = True
        rare = np.flatnonzero(~known)
        encoded = [chr(c).encode() for c in codes[rare].tolist()]
        hidden = np.zeros(len(codes), np.int64)
        hidden[rare] = [len(e) - 1 for e in encoded]
        base, arcs = len(self.first), len(self.reach)
        node = base + np.cumsum(1 + hidden) - 1
        weight = self.weight[piece]
        start = np.concatenate([start, rare])
        end = np.concatenate([start[: len(length)] + length - 1, rare])
        weight = np.concatenate([weight, (hidden[rare] + 1) * self.byte_weight])
        piece = np.concatenate([piece, self.bytes[[e[-1] for e in encoded]]]).astype(np.int32)
        before = np.where(start > begin[start], node[start - 1], -1)
        back = before.copy()
        chained = np.arange(len(back)) >= len(length)
        chained[chained] = hidden[rare] > 0
        back[chained] = node[end[chained]] - 1

        # Forward: the logarithm of the sum over all paths to each place, for all words at once.
        # By place in the word, then end, then start; a word's arcs come in the same order in any company.
        order = np.argsort(((end - begin[end]) * (len(codes) + 1) + end) * (self.longest + 2) + self.longest + 1 - (end - start))
        start, end, weight, piece, back = start[order], end[order], weight[order], piece[order], back[order]
        total = np.zeros(len(codes) + 1)  # the last one stands for the start of a word
        source = np.where(start > begin[start], start - 1, len(codes))
        level = end - begin[end]
        cuts = np.flatnonzero(np.diff(level, prepend=-1)).tolist() + [len(level)]
        for low, high in zip(cuts, cuts[1:]):
            value = total[source[low:high]] + weight[low:high]
            heads = np.flatnonzero(np.diff(end[low:high], prepend=-1))
            top = np.maximum.reduceat(value, heads)
            share = np.exp(value - np.repeat(top, np.diff(heads, append=high - low)))
            total[end[low + heads]] = top + np.log(np.add.reduceat(share, heads))
        share = np.exp(total[source] + weight - total[end])

        # The chains' arcs, then all arcs in the order of their nodes.
        owner = node[end]
        if len(rare):
            count = hidden[rare]
            at = np.repeat(rare, count)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
            inner = node[at] - hidden[at] + nth
            inner_back = np.where(nth > 0, inner - 1, np.where(at > begin[at], node[at - 1], -1))
            inner_piece = self.bytes[[b for e in encoded for b in e[:-1]]] if len(at) else np.zeros(0, np.int32)
            owner, back = np.concatenate([owner, inner]), np.concatenate([back, inner_back])
            share, piece = np.concatenate([share, np.ones(len(at))]), np.concatenate([piece, inner_piece])
        order = np.argsort(owner, kind="stable")
        owner, back, share, piece = owner[order], back[order], share[order], piece[order]
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        # Added up node by node, so that rounding doesn't depend on a word's company either.
        upto, width = share.copy(), np.diff(heads, append=len(owner))
        for nth in range(1, int(width.max(initial=0))):
            at = heads[width > nth] + nth
            upto[at] += upto[at - 1]
        upto[heads + width - 1] = 1.0

        self.first = np.concatenate([self.first, (arcs + heads).astype(np.int32)])
        self.reach = np.concatenate([self.reach, upto.astype(np.float32)])
        self.back = np.concatenate([self.back, back.astype(np.int32)])
        self.piece = np.concatenate([self.piece, piece.astype(np.int32)])
        self.last = np.concatenate([self.last, node[np.cumsum(sizes) - 1].astype(np.int32)])

    def encode(self, texts: list[str], keys: list[int], seed: int = SEED) -> list[np.ndarray]:
        """The sampled piece ids of each text."""
        if len(self.words) > WORDS_KEPT:
            self.clear()
        known = self.words
        held = len(known)
        numbers, counts = [], []
        for text in texts:
            parts = self.parts(" " + text) if text else []
            counts.append(len(parts))
            numbers.extend(map(known.__getitem__, parts))
        fresh = list(islice(reversed(known), len(known) - held))[::-1]
        for start in range(0, len(fresh), WORDS_AT_ONCE):
            self.add(fresh[start : start + WORDS_AT_ONCE])
        counts = np.array(counts, np.int64)
        key = np.repeat(np.array(keys, np.int64).view(np.uint64), counts)
        place = (np.arange(len(numbers)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint64)
        pieces, lengths = self._draw(np.array(numbers, np.int64), key, place, seed)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)]
        return np.split(pieces, ends[:-1]) if len(texts) else []

    def _draw(self, numbers, key, place, seed):
        """Pieces from the end of every word to its start, all words one step at a time."""
        node = self.last[numbers]
        lengths = np.zeros(len(numbers), np.int64)
        active = np.arange(len(numbers))
        base = _mixed(_mixed(key + np.uint64(seed)) + place * np.uint64(0x9E3779B97F4A7C15))
        taken = []
        while len(active):
            # 24 bits are exact in single precision and stay below 1.
            draw = (_mixed(base + np.uint64(len(taken))) >> np.uint64(40)).astype(np.float32) * np.float32(2**-24)
            arc = self.first[node]
            on = np.flatnonzero(draw >= self.reach[arc])
            while len(on):
                arc[on] += 1
                on = on[draw[on] >= self.reach[arc[on]]]
            taken.append((active, self.piece[arc]))
            lengths[active] += 1
            node = self.back[arc]
            more = node >= 0
            node, active, base = node[more], active[more], base[more]
        ends = np.cumsum(lengths)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
        for step, (of, found) in enumerate(taken):
            out[ends[of] - 1 - step] = found
        return out, lengths

    def decode(self, pieces) -> str:
        """The text of piece ids: bytes joined, the space before the first word dropped."""
        text = self.text
        return b"".join([text[p] for p in pieces])[1:].decode("utf-8", "replace")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def model_bytes(path: str = MODEL_FILE) -> bytes:
    """The model's file, read by the driver and sent along; such files have well under a megabyte or a few."""
    with open(path, "rb") as source:
        return source.read()


def _slices(batches, text: str):
    """The batches cut to about BYTES_AT_ONCE of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        upto = np.cumsum(sizes.astype(np.int64) + 1)
        cuts = np.searchsorted(upto, np.arange(BYTES_AT_ONCE, upto[-1], BYTES_AT_ONCE)) + 1 if len(upto) else []
        bounds = np.unique([0, *cuts, batch.num_rows]).tolist()
        for start, end in zip(bounds, bounds[1:]):
            yield batch.slice(start, end - start)


def _lists(ids: list[np.ndarray], texts: list) -> pa.Array:
    """The ids as a list column, null where the text is."""
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array([t is None for t in texts]))


def encoded(
    docs: DataFrame, key: str = "doc_id", text: str = "text", model_file: str = MODEL_FILE,
    theta: float = THETA, seed: int = SEED,
) -> DataFrame:
    """``docs`` with piece_ids, an array of ints, named apart from columns that are there.

    Null text has null ids, empty text none. The row key seeds the draws, so
    rows with equal key and text have equal ids; null keys count as one key. The
    smaller ``theta``, the more the segmentations vary.
    """
    out = free_name(docs, "piece_ids")
    content, row_key = free_name(docs, "content_"), free_name(docs, "row_key_")
    proto = model_bytes(model_file)
    rows = docs.withColumn(content, F.col(text)).withColumn(
        row_key, F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")))
    )
    schema = T.StructType([*docs.schema, T.StructField(out, T.ArrayType(T.IntegerType()))])

    def encode(batches):
        lattices = PieceLattices(proto, theta)
        for batch in _slices(batches, content):
            texts, keys = batch.column(content).to_pylist(), batch.column(row_key).to_pylist()
            kept = batch.drop_columns([content, row_key])
            lists = _lists(lattices.encode([t or "" for t in texts], keys, seed), texts)
            yield pa.RecordBatch.from_arrays([*kept.columns, lists], [*kept.schema.names, out])

    return rows.mapInArrow(encode, schema)


def decoded(rows: DataFrame, pieces: str = "piece_ids", model_file: str = MODEL_FILE) -> DataFrame:
    """``rows`` with decoded, the text of their pieces; null pieces have null text."""
    out = free_name(rows, "decoded")
    proto = model_bytes(model_file)
    schema = T.StructType([*rows.schema, T.StructField(out, T.StringType())])

    def decode(batches):
        lattices = PieceLattices(proto)
        for batch in batches:
            ids = batch.column(pieces).to_pylist()
            texts = pa.array([None if i is None else lattices.decode(i) for i in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, out])

    return rows.mapInArrow(decode, schema)


def round_trip(
    docs: DataFrame, key: str = "doc_id", text: str = "text", model_file: str = MODEL_FILE,
    theta: float = THETA, seed: int = SEED,
) -> DataFrame:
    """Encodes every text and decodes the ids: doc_id, n_pieces, piece_ids, ids_sha256, text_sha256, lossless.

    ids_sha256 is the digest of the ids as little-endian 32-bit numbers,
    text_sha256 that of the decoded text, lossless whether it equals the text.
    Null text: null ids and digests, zero pieces, lossless.
    """
    proto = model_bytes(model_file)
    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(text).alias("text_"),
        F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("key_"),
    )
    schema = T.StructType(
        [
            T.StructField("doc_id", rows.schema["doc_id"].dataType),
            T.StructField("n_pieces", T.LongType()),
            T.StructField("piece_ids", T.ArrayType(T.IntegerType())),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("text_sha256", T.StringType()),
            T.StructField("lossless", T.BooleanType()),
        ]
    )

    def both_ways(batches):
        give_back_memory()
        lattices = PieceLattices(proto, theta)
        for batch in _slices(batches, "text_"):
            texts, keys = batch.column("text_").to_pylist(), batch.column("key_").to_pylist()
            ids = lattices.encode([t or "" for t in texts], keys, seed)
            digests, sums, same = [], [], []
            for t, i in zip(texts, ids):
                back = None if t is None else lattices.decode(i.tolist())
                same.append(back == t)
                sums.append(None if t is None else hashlib.sha256(back.encode()).hexdigest())
                digests.append(None if t is None else hashlib.sha256(i.astype("<i4").tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(i) for i in ids], pa.int64()),
                    _lists(ids, texts),
                    pa.array(digests, pa.string()),
                    pa.array(sums, pa.string()),
                    pa.array(same, pa.bool_()),
                ],
                schema.names,
            )

    return rows.mapInArrow(both_ways, schema)
