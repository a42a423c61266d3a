"""SimHash near-duplicates by anchor-point covering.

Fingerprints have 64 bits. The anchors are the words of a covering code: on bits
0-22 and on bits 23-45 the binary Golay code, which is perfect with covering
radius 3, so that each half of a fingerprint has exactly one nearest word, its
home. A fingerprint that differs from another in d bits is at most 3 + d1 and
3 + d2 bits away from the homes of the other's halves, d1 + d2 <= d. So each is
replicated to every pair of code words within the radius plus a share of the
threshold, and at every anchor the fingerprints at home there are compared with
those replicated to it, over all 64 bits.

No link is lost, and the work follows the number of distinct fingerprints: the
number of replicas (61 on average for 2 bits) and of fingerprints within d bits
(at most 2,080 for 2) do not depend on the data. Copies share a fingerprint and
meet only in aggregates and joins.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import free_name, give_back_memory, row_hash, stored
from shelfmark.llm.components import connected_components

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
LENGTH, RADIUS = 23, 3
AT_ONCE = 1 << 16


def fingerprint(text: str | None, words_per_shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned; a bit is 1 if more than half of the shingles' hashes set it."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    rest = [words[i:] for i in range(min(words_per_shingle, len(words)))]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(b" ".join(shingle), seed) for shingle in zip(*rest)])
    bits = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(bits), AT_ONCE):
        ones += np.unpackbits(bits[start : start + AT_ONCE], axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > len(bits)).tobytes(), "big")


def fingerprints(
    docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",),
    words_per_shingle: int = SHINGLE_WORDS, seed: int = SEED,
) -> DataFrame:
    """(keys, fingerprint as a signed long) of every row.

    Only the text goes through Python; pandas would round long keys next to a null.
    """

    def hashed(texts: pd.Series) -> pd.Series:
        prints = [fingerprint(t, words_per_shingle, seed) for t in texts]
        give_back_memory()
        return pd.Series(np.array(prints, np.uint64).astype(np.int64))

    return docs.select(*keys, F.pandas_udf(hashed, "long")(F.col(text)).alias("fingerprint"))


def golay_cosets(threshold: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Syndromes of the 23-bit values' low and high parts, and error patterns by syndrome.

    The patterns are listed by excess: first the coset leader (at most 3 bits),
    then those of 4, 5, ... bits, padded with -1.
    """
    syndrome = np.zeros(LENGTH, np.int64)
    for bit in range(LENGTH):
        value = 1 << bit
        for high in range(LENGTH - 1, 10, -1):
            if value >> high & 1:
                value ^= GENERATOR << (high - 11)
        syndrome[bit] = value
    grouped: list[dict[int, list[int]]] = [{} for _ in range(threshold + 1)]
    for weight in range(RADIUS + threshold + 1):
        for bits in combinations(range(LENGTH), weight):
            of = int(np.bitwise_xor.reduce(syndrome[list(bits)])) if bits else 0
            grouped[max(0, weight - RADIUS)].setdefault(of, []).append(sum(1 << b for b in bits))
    tables = []
    for patterns in grouped:
        table = np.full((1 << 11, max(map(len, patterns.values()))), -1, np.int64)
        for of, errors in patterns.items():
            table[of, : len(errors)] = errors
        tables.append(table)
    return syndrome, tables


def _syndromes(values: np.ndarray, syndrome: np.ndarray) -> np.ndarray:
    out = np.zeros_like(values)
    for bit in range(LENGTH):
        out ^= (values >> bit & 1) * syndrome[bit]
    return out


def anchors(prints: np.ndarray, threshold: int, syndrome, tables):
    """(anchor, fingerprint, at home) of all replicas."""
    mask = (1 << LENGTH) - 1
    low, high = prints & mask, prints >> LENGTH & mask
    of_low, of_high = _syndromes(low, syndrome), _syndromes(high, syndrome)
    for i in range(threshold + 1):
        for j in range(threshold + 1 - i):
            a, b = tables[i][of_low], tables[j][of_high]
            valid = (a >= 0)[:, :, None] & (b >= 0)[:, None, :]
            code = (low[:, None] ^ a)[:, :, None] | ((high[:, None] ^ b) << LENGTH)[:, None, :]
            rows = np.broadcast_to(prints[:, None, None], code.shape)
            yield code[valid], rows[valid], i == j == 0


def linked_fingerprints(distinct: DataFrame, threshold: int = MAX_BITS) -> DataFrame:
    """(u, v): every two of the distinct fingerprints at most ``threshold`` bits apart, both ways."""
    if not 0 <= threshold <= 4:
        raise ValueError("the threshold is 0 to 4 bits")

    def replicas(at_home):
        def emit(frames):
            syndrome, tables = golay_cosets(threshold)
            for frame in frames:
                values = frame["fingerprint"].to_numpy()
                for start in range(0, len(values), 4096):
                    for anchor, prints, home in anchors(values[start : start + 4096], threshold, syndrome, tables):
                        if home or not at_home:
                            yield pd.DataFrame({"anchor": anchor, "print": prints})
            give_back_memory()

        return emit

    prints = distinct.select("fingerprint")
    at_home = prints.mapInPandas(replicas(True), "anchor long, print long").withColumnRenamed("print", "u")
    guests = prints.mapInPandas(replicas(False), "anchor long, print long").withColumnRenamed("print", "v")
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= threshold
    return at_home.join(guests, "anchor").where((F.col("u") != F.col("v")) & near).select("u", "v").distinct()


def _grouped(docs: DataFrame, text: str, keys: tuple[str, ...], words_per_shingle: int, max_bits: int) -> DataFrame:
    """keys, fingerprint, root (a group's own least fingerprint), component_id (its least first key)."""
    prints = stored(fingerprints(docs, text, keys, words_per_shingle), "fingerprints")
    distinct = stored(prints.groupBy("fingerprint").agg(F.min(keys[0]).alias("least_id")), "distinct")
    roots = connected_components(linked_fingerprints(distinct, max_bits))
    rooted = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least_id", F.coalesce("root", "fingerprint").alias("root")
    )
    groups = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    member_of = rooted.join(groups, "root").select("fingerprint", "root", "component_id")
    return prints.join(member_of, "fingerprint")


def near_duplicate_groups(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
    words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
) -> DataFrame:
    """A row per document: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id in the group of all documents that can be
    reached over links. Null and empty texts have fingerprint zero and are
    linked like others. Null ids take part but are nobody's component_id, which
    is null where a group has no other. Repeated rows are kept. No rows: no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _grouped(rows, "text", ("doc_id",), words_per_shingle, max_bits).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def near_dedup(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
    words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
) -> DataFrame:
    """``docs`` with one document of each group, that with the smallest id; all columns kept.

    Null ids are above all others. Of rows that repeat the smallest id one stays,
    by a hash over all columns.
    """
    mark = free_name(docs, "row_mark")
    marked = docs.withColumn(mark, row_hash(docs))
    rows = marked.select(F.col(doc_id).alias("id_"), F.col(text).alias("text_"), F.col(mark).alias("mark_"))
    chosen = (
        _grouped(rows, "text_", ("id_", "mark_"), words_per_shingle, max_bits)
        .where(F.col("id_").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct("mark_", "id_")).alias("one"))
        .select("one.id_", "one.mark_")
    )
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("id_")) & (F.col(mark) == F.col("mark_"))
    kept = marked.join(chosen, same, "left_semi")
    first = Window.partitionBy(mark, f"`{doc_id}`").orderBy(F.lit(1))
    order = free_name(kept, "order_")
    return kept.withColumn(order, F.row_number().over(first)).where(F.col(order) == 1).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
