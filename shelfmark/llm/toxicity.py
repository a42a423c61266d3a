"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms, hashed. The machine adds a bias, a weight per
term and, for every two terms, the product of their factor vectors; so a pair,
such as an insult and the mention of a group, can count for more than its parts.
The sum over pairs takes time linear in the terms: half of (sum of vectors)^2
less the sum of their squares.

It is learned by Adagrad in numpy on a bounded sample of labelled rows. All terms
of the sample have a weight and factors, and none is left out; a term that is not
in the sample has none. How far the sample can vouch for a term scales it
smoothly: its weight by chi-squared, its factors by the number of documents, so a
term that says nothing by itself still takes its part in pairs.
"""

from __future__ import annotations

import pickle
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import remainder_of

SAMPLE_ROWS = 20_000
HASH_BITS = 22
HALF_CHI2 = 15.0  # a term of this chi-squared learns its weight at half scale
HALF_DOCUMENTS = 30.0  # a term of so many documents learns its factors at half scale
FACTORS = 8
EPOCHS = 15
BATCH = 256
BATCH_TERMS = 1 << 20
# Chosen on validation rows among those that may be learned from, see README.
RATE = 0.8
FACTOR_RATE = 0.02
L2 = 1e-5
THRESHOLD = 0.3
_TERM = re.compile(r"[^\W\d_]+")


def term_hashes(text: str | None) -> set[int]:
    """The hashed distinct terms of a whole text: its lower-cased runs of letters."""
    mask = (1 << HASH_BITS) - 1
    return {zlib.crc32(t.encode()) & mask for t in set(_TERM.findall((text or "").lower()))}


class Places:
    """The place of each hashed term that the machine knows."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms

    def __len__(self) -> int:
        return len(self.terms)

    def __contains__(self, term: int) -> bool:
        return len(self.of(np.array([term]))) == 1

    def __getitem__(self, term: int) -> int:
        return int(self.of(np.array([term]))[0])

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The places of those hashes that are known."""
        at = np.searchsorted(self.terms, hashes)
        known = at < len(self.terms)
        known[known] = self.terms[at[known]] == hashes[known]
        return at[known]


def _raw(x: np.ndarray, model: dict) -> np.ndarray:
    mixed = x @ model["factors"]
    squares = (x * x) @ (model["factors"] ** 2)
    return model["bias"] + x @ model["weights"] + 0.5 * (mixed * mixed - squares).sum(axis=1)


def _raw_of(hashes: np.ndarray, model: dict) -> float:
    """``_raw`` of one document by its hashed terms."""
    at = model["place"].of(hashes)
    factors = model["factors"][at].astype(np.float64)
    mixed = factors.sum(axis=0)
    pairs = 0.5 * float((mixed * mixed).sum() - (factors * factors).sum())
    return model["bias"] + float(model["weights"][at].sum(dtype=np.float64)) + pairs


def _probability(raw: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def _batches(order: np.ndarray, sizes: np.ndarray):
    """``order`` cut to BATCH documents, fewer where they have over BATCH_TERMS terms together."""
    for start in range(0, len(order), BATCH):
        some = order[start : start + BATCH]
        part = np.cumsum(sizes[some]) // BATCH_TERMS
        yield from np.split(some, np.flatnonzero(np.diff(part)) + 1)


def _run_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sums of runs of ``sizes`` values, one run after the other; 0 for empty runs."""
    sums = np.zeros((len(sizes), *values.shape[1:]), values.dtype)
    if len(values):
        sums[sizes > 0] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[sizes > 0])
    return sums


def fit(rows: list[np.ndarray], labels: np.ndarray, seed: int = 11) -> dict:
    """The machine learned from hashed rows: terms, weights, factors, bias."""
    n, positive = len(rows), float(labels.sum())
    sizes = np.array([len(row) for row in rows], np.int64)
    starts = np.cumsum(sizes) - sizes
    terms, place = np.unique(np.concatenate([np.zeros(0, np.int32), *rows]), return_inverse=True)
    place = place.astype(np.int32)
    seen = np.bincount(place, minlength=len(terms))
    toxic = np.bincount(place, np.repeat(labels, sizes), minlength=len(terms))
    expected = seen * (positive / max(n, 1))
    spread = expected * (1 - positive / max(n, 1)) * (1 - seen / max(n, 1))
    chi2 = np.where(spread > 0, (toxic - expected) ** 2 / np.maximum(spread, 1e-9), 0)
    alone = (chi2**2 / (chi2**2 + HALF_CHI2**2)).astype(np.float32)
    paired = (seen / (seen + HALF_DOCUMENTS)).astype(np.float32)[:, None]
    rng = np.random.default_rng(seed)
    rate = min(max(positive / max(n, 1), 1e-3), 1 - 1e-3)
    bias, grown_bias = float(np.log(rate / (1 - rate))), 1e-8
    weights = np.zeros(len(terms), np.float32)
    factors = rng.normal(0, 0.01, (len(terms), FACTORS)).astype(np.float32)
    grown_weights, grown_factors = np.full_like(weights, 1e-8), np.full_like(factors, 1e-4)
    for _ in range(EPOCHS):
        for docs in _batches(rng.permutation(n), sizes):
            size = sizes[docs]
            at = place[np.arange(size.sum()) + np.repeat(starts[docs] - (np.cumsum(size) - size), size)]
            vectors = factors[at] * paired[at]
            mixed = _run_sums(vectors, size)
            squares = _run_sums((vectors * vectors).sum(axis=1), size)
            raw = bias + _run_sums(weights[at] * alone[at], size) + 0.5 * ((mixed * mixed).sum(axis=1) - squares)
            error = ((_probability(raw) - labels[docs]) / len(docs)).astype(np.float32)
            of_term = np.repeat(error, size)
            slopes = np.column_stack(
                [of_term * alone[at], (np.repeat(error[:, None] * mixed, size, axis=0) - of_term[:, None] * vectors) * paired[at]]
            )
            by_place = np.argsort(at, kind="stable")
            changed, times = np.unique(at, return_counts=True)
            slopes = _run_sums(slopes[by_place], times)
            slope = slopes[:, 0] + L2 * weights[changed]
            grown_weights[changed] += slope * slope
            weights[changed] -= RATE * slope / np.sqrt(grown_weights[changed])
            slope = slopes[:, 1:] + L2 * factors[changed]
            grown_factors[changed] += slope * slope
            factors[changed] -= FACTOR_RATE * slope / np.sqrt(grown_factors[changed])
            grown_bias += float(error.sum()) ** 2
            bias -= RATE * float(error.sum()) / grown_bias**0.5
    return {"place": Places(terms), "bias": bias, "weights": weights * alone, "factors": factors * paired}


def trained(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> dict | None:
    """The machine learned from labelled rows whose crc32(doc_id) mod 4 is not 2.

    About ``sample_rows`` of them, by a hash of the id; null ids and labels are
    left out, and of an id with several labels the highest counts. Fitted in one
    task. None without labelled rows.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & (remainder_of(F.col(doc_id), 4) != 2))
        .groupBy(F.col(doc_id).alias("id"))
        .agg(F.max(label).cast("int").alias("label"))
    )
    n = known.count()
    if not n:
        return None
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), "id"), F.lit(1 << 20)) / float(1 << 20)
    drawn = known.where(draw < min(1.0, sample_rows / n))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(drawn, "id")

    def hashed(frames):
        for frame in frames:
            terms = [np.fromiter(sorted(term_hashes(t)), np.int32).tobytes() for t in frame["text"]]
            yield pd.DataFrame({"id": frame["id"].astype(str), "label": frame["label"], "terms": terms})

    def train(frames):
        got = pd.concat(list(frames), ignore_index=True)
        if len(got):
            got = got.sort_values(["id", "terms"], kind="stable")
            model = fit([np.frombuffer(t, np.int32) for t in got["terms"]], got["label"].to_numpy(np.float64))
            plain = model | {"place": model["place"].terms}
            yield pd.DataFrame({"model": [zlib.compress(pickle.dumps(plain), 1)]})

    found = (
        rows.mapInPandas(hashed, "id string, label int, terms binary")
        .repartition(1)
        .mapInPandas(train, "model binary")
        .collect()
    )
    if not found:
        return None
    plain = pickle.loads(zlib.decompress(found[0]["model"]))
    return plain | {"place": Places(plain["place"])}


def scored(docs: DataFrame, model: dict | None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Null and empty texts have no terms and get the bias alone. Without a model
    the score is 0. Whole texts are read, and only they go through Python: pandas
    would round long ids next to a null.
    """

    def score(texts: pd.Series) -> pd.Series:
        found = np.zeros(len(texts))
        if model:
            raw = [_raw_of(np.fromiter(term_hashes(t), np.int32), model) for t in texts]
            found = _probability(np.array(raw, np.float64))
        return pd.Series(found)

    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (remainder_of(F.col(doc_id), 4) == 2).alias("held_out"),
        F.pandas_udf(score, "double")(F.col(text)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, by a machine learned from ``labels``."""
    return scored(docs, trained(docs, labels))
