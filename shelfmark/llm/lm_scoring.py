"""Language-model scoring with a weighted backoff automaton of order three.

The model smooths each order with the one below it, by a prior of fixed weight:

    P(w)       = (c(w) + 1) / (N + V + 1)
    P(w | v)   = (c(v w) + K1 P(w)) / (c(v) + K1)             K1, K2 = PRIORS
    P(w | u v) = (c(u v w) + K2 P(w | v)) / (c(u v) + K2)

As an automaton, the states are the root, every word seen in training (a text's
start is one) and every pair of words seen. A state has an arc for each word seen
after it, of weight P(w | state), which leads to the state of the longest suffix
that was seen. Its failure arc, of weight K / (c(state) + K), leads to the state
without its first word. The root has an arc for every word. A text is walked once
from left to right: the walk carries the state, follows failure arcs until there
is an arc for the word, takes it, and adds up the logarithms of the weights. Each
state's weights sum to one with what its failure arc passes on.

Where a walk stands depends on the last two words only. So a long text is walked
in segments side by side, each begun two words early at the root.

The counts are of the whole training corpus and no machine holds them. The texts
are dealt to blocks of bounded size. A block sends each of its distinct words,
pairs and triples once, as a hash and its count, to the part that owns the hash;
the part adds up and answers each block with the totals of what it asked for. So
a block gets just the arcs that its own texts can walk, and what travels is its
distinct n-grams, not its tokens. They are spread by their own hash: a frequent
word's pairs go to all parts, and an n-gram has one entry per block at most.

N-grams are told apart by hashes of 56 bits: of 10^13 triples, as 100 TB of text
may have, one in 7,000 shares its hash.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import give_back_memory, remainder_of

BLOCK_BYTES = 16 << 20
BLOCK_ROWS = 50_000
# A block has a distinct pair for about ten bytes, and asks a part for at least
# this many of them: with very much text the blocks grow as its square root.
ASKED_AT_ONCE = 64
# Weights of the prior of word and pair states, the best of those tried on a
# validation part of the training rows.
PRIORS = (10_000.0, 30.0)
SEGMENT = 256
KEY_BITS = 56
ORDERS = ("words", "pairs", "triples")
END, START = b"\n", b" "  # no words


def _packed(values: np.ndarray) -> bytes:
    """64-bit numbers, byte planes apart, so that small ones take little room."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _distinct(keys: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each is among those to learn from."""
    tagged = np.sort(keys << np.uint64(1) | learn.astype(np.uint64))
    keys = tagged >> np.uint64(1)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    counts = np.add.reduceat(tagged & np.uint64(1), first) if len(first) else tagged
    return keys[first], counts


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key its number among the distinct ones in order; for each distinct one a place where it is."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.append(True, ordered[1:] != ordered[:-1])[: len(keys)]
    numbers = np.empty(len(keys), np.int32)
    numbers[order] = np.cumsum(new, dtype=np.int32) - 1
    return numbers, order[new]


class BlockText:
    """A block's tokens, and the hashes of the word, pair and triple that end at each.

    A text's first token has a pair, with the start, but no triple.
    """

    def __init__(self, texts: list, train: list[bool]):
        numbers: dict[bytes, int] = {END: 0, START: 1}
        tokens, lengths = [], []
        for text in texts:
            words = (text or "").encode().lower().split()
            words.append(END)
            tokens.append(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int32))
            lengths.append(len(words))
        self.lengths = np.array(lengths, np.int64)
        self.tokens = np.concatenate(tokens)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.train = np.array(train, bool)
        self.learn = np.repeat(self.train, self.lengths)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
        spare = np.uint64(64 - KEY_BITS)
        self.words = hashes >> spare
        here = hashes[self.tokens]
        before = np.roll(here, 1)
        before[self.starts] = hashes[1]
        pairs = _mixed(_mixed(before) + here)
        self.inner = np.ones(len(here), bool)
        self.inner[self.starts] = False
        triples = _mixed(_mixed(np.roll(pairs, 1)) + here)
        self.pairs, self.triples = pairs >> spare, triples[self.inner] >> spare

    def counts(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Distinct keys and their counts in training texts, by order. A text's start counts as a word."""
        starts = np.full(len(self.starts), self.words[1])
        return [
            _distinct(np.append(self.words[self.tokens], starts), np.append(self.learn, self.train)),
            _distinct(self.pairs, self.learn),
            _distinct(self.triples, self.learn[self.inner]),
        ]


def _part_of(sorted_keys: np.ndarray, parts: int) -> np.ndarray:
    """The part that owns each key; it rises with the key."""
    return ((sorted_keys >> np.uint64(KEY_BITS - 32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _asked(block: int, text: BlockText, parts: int) -> pd.DataFrame:
    """A row for each part that the block asks: its sorted keys and their counts in the block."""
    bounds = [
        (keys, counts, np.searchsorted(_part_of(keys, parts), np.arange(parts + 1))) for keys, counts in text.counts()
    ]
    rows = []
    for part in np.flatnonzero(sum(np.diff(cuts) for _, _, cuts in bounds)).tolist():
        cells = []
        for keys, counts, cuts in bounds:
            some = slice(cuts[part], cuts[part + 1])
            cells += [_packed(np.diff(keys[some], prepend=np.uint64(0))), _packed(counts[some])]
        rows.append((part, block, *cells))
    return pd.DataFrame(rows, columns=["part", "block", *(f"{o}{c}" for o in ORDERS for c in ("", "_counts"))])


def _answered(frame: pd.DataFrame) -> pd.DataFrame:
    """For each block that asked, the totals of its keys; the part's own sums on one row."""
    answers, tokens, types = {}, 0, 0
    start_key = np.uint64(xxhash.xxh64_intdigest(START) >> (64 - KEY_BITS))
    for order in ORDERS:
        keys = [np.cumsum(_unpacked(b), dtype=np.uint64) for b in frame[order]]
        counts = np.concatenate([_unpacked(b) for b in frame[f"{order}_counts"]])
        place, where = _numbered(np.concatenate(keys))
        totals = np.zeros(len(where), np.uint64)
        np.add.at(totals, place, counts)
        if order == "words":
            real = np.concatenate(keys)[where] != start_key
            tokens, types = int(totals[real].sum()), int((totals[real] > 0).sum())
        ends = np.cumsum([len(k) for k in keys])
        answers[f"{order}_totals"] = [_packed(totals[p]) for p in np.split(place, ends[:-1])]
        del keys, counts, place, where, totals
    give_back_memory()
    first = np.arange(len(frame)) == 0
    return pd.DataFrame(
        {
            "block": frame["block"],
            "part": frame["part"],
            **answers,
            "tokens": np.where(first, tokens, 0),
            "types": np.where(first, types, 0),
        }
    )


class BackoffAutomaton:
    """The states and arcs that a block's texts can walk, with the log10 of their weights.

    ``totals`` are those of the block's distinct keys, by order. State 0 is the
    root, then come the words and the pairs of the block; those not seen in
    training are never reached. Arcs are numbered alike: words (from the root),
    pairs (from a word), triples (from a pair).
    """

    def __init__(self, text: BlockText, totals: list[np.ndarray], size: int, priors: tuple[float, float]):
        number, _ = _numbered(text.words)
        words = totals[0][number].astype(float)
        pair, pair_at = _numbered(text.pairs)
        inner, inner_at = _numbered(text.triples)
        places = np.flatnonzero(text.inner)
        triple_at = places[inner_at]
        pairs, triples = totals[1].astype(float), totals[2].astype(float)
        w, p = len(words), len(pairs)
        if [p, len(triples)] != [len(pair_at), len(inner_at)]:
            raise RuntimeError("the totals don't belong to this block")
        self.seen = words > 0

        left = np.roll(text.tokens, 1)
        left[text.starts] = 1
        of_word, right = words[left[pair_at]], text.tokens[pair_at]
        long, short = pair[triple_at - 1], pair[triple_at]
        root = (words + 1.0) / size
        from_word = (pairs + priors[0] * root[right]) / (of_word + priors[0])
        from_pair = (triples + priors[1] * from_word[short]) / (pairs[long] + priors[1])
        self.root = np.log10(root)
        self.weight = np.concatenate([self.root, np.log10(from_word), np.log10(from_pair)])
        self.exists = np.concatenate([np.ones(w, bool), pairs > 0, triples > 0])
        word_state = np.where(self.seen, 1 + np.arange(w), 0).astype(np.int32)
        self.target = np.concatenate([word_state, np.arange(1 + w, 1 + w + p, dtype=np.int32), 1 + w + short])

        self.level = np.repeat(np.arange(3, dtype=np.int8), [1, w, p])
        self.fail_to = np.concatenate([np.zeros(1 + w, np.int32), word_state[right]])
        self.fail = np.log10(
            np.concatenate([[1.0], priors[0] / (words + priors[0]), priors[1] / (pairs + priors[1])])
        )
        self.start = word_state[1]
        # By the level of the state, the arc that a token asks for.
        self.arc = np.zeros((3, len(text.tokens)), np.int32)
        self.arc[0], self.arc[1] = text.tokens, w + pair
        self.arc[2, places] = w + p + inner

    def walk(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 of the weight of each token's step, failure arcs included."""
        steps = np.zeros(self.arc.shape[1])
        in_text = -(-lengths // SEGMENT)
        text = np.repeat(np.arange(len(starts)), in_text)
        offset = SEGMENT * (np.arange(len(text)) - np.repeat(np.cumsum(in_text) - in_text, in_text))
        early = np.where(offset > 0, 2, 0)
        size = np.minimum(lengths[text] - offset, SEGMENT) + early
        longest_first = np.argsort(-size, kind="stable")
        place = (starts[text] + offset - early)[longest_first]
        early, size = early[longest_first], size[longest_first]
        state = np.where(early > 0, 0, self.start).astype(np.int32)
        for step in range(int(size[0]) if len(size) else 0):
            active = np.searchsorted(-size, -step, side="left")
            state, here = state[:active], place[:active] + step
            arc = self.arc[self.level[state], here]
            cost = np.zeros(active)
            failing = np.flatnonzero(~self.exists[arc])
            while len(failing):
                cost[failing] += self.fail[state[failing]]
                state[failing] = self.fail_to[state[failing]]
                arc[failing] = self.arc[self.level[state[failing]], here[failing]]
                failing = failing[~self.exists[arc[failing]]]
            cost += self.weight[arc]
            state = self.target[arc]
            counted = step >= early[:active]
            steps[here[counted]] = cost[counted]
        return steps


def scored(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", priors: tuple[float, float] = PRIORS,
    block_bytes: int | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    The model learns from rows whose crc32(doc_id) mod 7 is not 2. Null text is
    empty and has one token, the end. Rows that repeat an id and a text fall into
    the same block. Without training rows N and V are 0 and every token has
    probability 1. No rows: no rows. ``block_bytes`` is the text that a task
    holds, 16 MB by default and 330 MB at 170 TB of text; scores do not depend on it.
    """
    n_bytes, n_rows = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)), F.count("*")).first()
    if block_bytes is None:
        block_bytes = max(BLOCK_BYTES, math.isqrt(10 * ASKED_AT_ONCE * n_bytes))
    # Rows are small where there are many in a block; the rows of large blocks may be more.
    rows_in_block = block_rows * max(1, block_bytes // BLOCK_BYTES)
    blocks = int(max(1, -(-n_bytes // block_bytes), -(-n_rows // rows_in_block)))
    dealt = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        (remainder_of(F.col(doc_id), 7) == 2).alias("held_out"),
        F.pmod(F.xxhash64(F.col(doc_id), F.xxhash64(text)), F.lit(blocks)).cast("int").alias("block"),
    ).repartitionById(blocks, "block")

    def ask(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        train = [not h for h in table.column("held_out").to_pylist()]
        asked = _asked(block, BlockText(table.column("text").to_pylist(), train), blocks)
        give_back_memory()
        return pa.Table.from_pandas(asked, schema=pa.schema(asked_types), preserve_index=False)

    asked_types = [("part", pa.int32()), ("block", pa.int32())]
    asked_types += [(f"{o}{c}", pa.binary()) for o in ORDERS for c in ("", "_counts")]
    asked = dealt.groupBy("block").applyInArrow(
        ask, "part int, block int, " + ", ".join(f"{o} binary, {o}_counts binary" for o in ORDERS)
    )
    answers = (
        asked.repartitionById(blocks, "part")
        .groupBy("part")
        .applyInPandas(
            _answered,
            "block int, part int, " + "".join(f"{o}_totals binary, " for o in ORDERS) + "tokens long, types long",
        )
        .repartitionById(blocks, "block")
    )
    # The sums read the answers whole, so that Spark can use the exchange again that deals them to the blocks.
    sums = answers.agg(
        F.sum("tokens").alias("tokens"),
        F.sum("types").alias("types"),
        F.max(sum(F.octet_length(f"{o}_totals") for o in ORDERS)).alias("largest"),
        F.max("block").alias("last_block"),
        F.max("part").alias("last_part"),
    )
    known = dealt.withColumn("n", sums.select(F.struct("tokens", "types", "largest", "last_block", "last_part")).scalar())
    known = known.select("doc_id", "text", "held_out", "block", F.col("n.tokens").alias("tokens"), F.col("n.types").alias("types"))
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("train_tokens", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def walk(texts: pa.Table, totals: pa.Table) -> pa.Table:
        held_out = texts.column("held_out")
        block = BlockText(texts.column("text").to_pylist(), [not h for h in held_out.to_pylist()])
        n, v = texts.column("tokens")[0].as_py(), texts.column("types")[0].as_py()
        totals = totals.sort_by("part")
        got = [np.concatenate([_unpacked(b) for b in totals.column(f"{o}_totals").to_pylist()]) for o in ORDERS]
        automaton = BackoffAutomaton(block, got, n + v + 1, priors)
        del got, totals, block.pairs, block.triples
        give_back_memory()
        steps = automaton.walk(block.starts, block.lengths)
        base = automaton.root[block.tokens]
        known_tokens = automaton.seen[block.tokens].astype(np.int64)
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "held_out": held_out,
                "n_tokens": block.lengths,
                "n_known": np.add.reduceat(known_tokens, block.starts),
                "train_tokens": np.full(len(block.lengths), n, np.int64),
                "base_score": np.add.reduceat(base, block.starts),
                "score": np.add.reduceat(steps, block.starts),
            }
        )

    return known.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(walk, schema)
