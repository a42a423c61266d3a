"""Hard negatives by segment summary filtering.

A vector is cut into equal segments; of each its mean and its deviation (the
norm of what is left without the mean) are stored. For two segments of length L
the inner product is L * mean * mean, plus or minus at most the product of the
deviations (Cauchy-Schwarz), so the sums over segments bound the score from both
sides. The summaries form levels of 1, 4 and 16 segments, each cutting the
segments of the level before: pairs that a coarse level leaves in doubt are
bounded again by the next one, and only pairs in doubt at the finest level are
scored exactly, in integers.

A pair is out when its upper bound is under the lowest score still wanted for
its anchor (which rises as better rows are found), or its lower bound over the
highest allowed one. Nothing else is left out, so results are exact.

Anchors meet all rows in cells: a block of anchors with a block of rows, both of
bounded size however many rows a label has. A cell gives at most k rows for each
of its anchors and windows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import stored

SCALE = 256
LEVELS = (1, 4, 16)
ANCHORS_A_CELL = 2048
ROWS_A_CELL = 1 << 14
AT_ONCE = 1024
LONG = np.iinfo(np.int64)
# A relative error far above what the sums in double precision can have.
SLACK = 1e-9

FOUND = "anchor long, anchor_id long, place int, positive_id long, positive_known boolean, positive_score long, "
FOUND += "row long, vec_id long, known boolean, score long"


def cut(width: int, segments: int) -> np.ndarray:
    """Where ``segments`` nearly equal segments start; each level cuts inside those of coarser ones."""
    return np.unique(np.arange(segments) * width // segments)


def summaries(vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """By level: means times the root of the segment's length, and deviations."""
    width = vectors.shape[1]
    out = []
    for segments in LEVELS if width else ():
        starts = cut(width, segments)
        lengths = np.diff(np.append(starts, width))
        means = np.add.reduceat(vectors, starts, axis=1) / lengths
        rest = vectors - np.repeat(means, lengths, axis=1)
        out.append((means * np.sqrt(lengths), np.sqrt(np.add.reduceat(rest * rest, starts, axis=1))))
    return out


def _packed(levels: list[tuple[np.ndarray, np.ndarray]], rows: int) -> np.ndarray:
    return np.column_stack([part for level in levels for part in level]) if levels else np.zeros((rows, 0))


def _unpacked(packed: np.ndarray, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for segments in LEVELS if width else ():
        n = len(cut(width, segments))
        out.append((packed[:, at : at + n], packed[:, at + n : at + 2 * n]))
        at += 2 * n
    return out


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors; beyond 64 bits the nearest long."""
    if not a.size or not x.size:
        return np.zeros((len(a), len(x)), np.int64)
    most = max(abs(int(a.max())), abs(int(a.min()))) * max(abs(int(x.max())), abs(int(x.min()))) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a @ x.T
    exact = a.astype(object) @ x.astype(object).T
    return np.clip(exact, int(LONG.min), int(LONG.max)).astype(np.int64)


class Best:
    """The k best rows of every anchor's windows: higher scores first, then known and smaller ids, then rows."""

    def __init__(self, low: np.ndarray, k: int):
        self.k, self.windows, self.low = k, low.shape[1], low
        self.least = low.copy()  # the lowest score that can still get in
        self.held = np.zeros((0, 5), np.int64)  # slot, score, unknown id, id, row

    def add(self, slots, scores, unknown, ids, rows) -> None:
        new = np.column_stack([slots, scores, unknown, ids, rows]).astype(np.int64, copy=False)
        held = np.concatenate([self.held, new])
        # The complement turns the order round without overflow.
        held = held[np.lexsort((held[:, 4], held[:, 3], held[:, 2], ~held[:, 1], held[:, 0]))]
        first = np.searchsorted(held[:, 0], held[:, 0], side="left")
        place = np.arange(len(held)) - first
        self.held = held[place < self.k]
        last = held[place == self.k - 1]
        self.least.reshape(-1)[last[:, 0]] = last[:, 1]


def mined(anchors: dict, rows: dict, low: np.ndarray, high: np.ndarray, k: int, same_label: bool) -> np.ndarray:
    """(slot, score, unknown, id, row): for each anchor's window low..high its k best rows; slot = anchor * windows + window.

    ``anchors`` and ``rows`` have arrays row, id, unknown, label, vector (integers)
    and summary (levels). An anchor meets rows of its own label only, or of other
    labels only, never itself.
    """
    best = Best(low, k)
    windows = low.shape[1]
    norm = math.sqrt(float((anchors["vector"].astype(float) ** 2).sum(axis=1).max(initial=0)))
    for start in range(0, len(rows["row"]), AT_ONCE):
        part = slice(start, start + AT_ONCE)
        vector = rows["vector"][part]
        alike = anchors["label"][:, None] == rows["label"][part][None, :]
        alive = alike if same_label else ~alike
        alive &= anchors["row"][:, None] != rows["row"][part][None, :]
        slack = SLACK * (1 + norm * math.sqrt(float((vector.astype(float) ** 2).sum(axis=1).max(initial=0))))
        for (a_mean, a_rest), (x_mean, x_rest) in zip(anchors["summary"], rows["summary"]):
            a, x = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            if not len(a):
                break
            middle = a_mean[a] @ x_mean[part][x].T
            spread = a_rest[a] @ x_rest[part][x].T + slack
            wanted = np.zeros(middle.shape, bool)
            for w in range(windows):
                reaches = middle + spread >= best.least[a, w][:, None].astype(float)
                wanted |= reaches & (middle - spread <= high[a, w][:, None].astype(float))
            alive[np.ix_(a, x)] &= wanted
        a, x = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(a):
            continue
        scores = products(anchors["vector"][a], vector[x])
        doubtful = alive[np.ix_(a, x)]
        for w in range(windows):
            i, j = np.nonzero(
                doubtful & (scores >= best.least[a, w][:, None]) & (scores <= high[a, w][:, None])
            )
            of = start + x[j]
            best.add(a[i] * windows + w, scores[i, j], rows["unknown"][of], rows["id"][of], rows["row"][of])
    return best.held


def prepared(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """Rows that take part, with integer vectors and summaries, stored.

    Columns: row (tells rows apart), vec_id (0 where unknown), known, label,
    vector, summary, width. Left out: null labels, null vectors, vectors with null
    or non-finite components.
    """
    x = F.transform(F.col("vector"), lambda v: F.floor(v * float(SCALE)))
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf))
    doubles = F.transform(F.col(f"`{embedding}`"), lambda v: v.cast("double"))
    number, given = F.col(f"`{vec_id}`").cast("long"), F.col(f"`{label}`").cast("long")
    rows = (
        vectors.select(number.alias("id_"), given.alias("given"), doubles.alias("vector"))
        .where(F.col("given").isNotNull() & F.col("vector").isNotNull() & fine)
        .select(
            F.monotonically_increasing_id().alias("row"),
            F.coalesce("id_", F.lit(0)).alias("vec_id"),
            F.col("id_").isNotNull().alias("known"),
            F.when(F.col("id_") % 7 == 0, (F.col("given") + 1) % 10).otherwise(F.col("given")).alias("label"),
            x.alias("vector"),
            F.size("vector").alias("width"),
        )
    )

    def summarise(frames):
        for frame in frames:
            out: list = [None] * len(frame)
            for width, at in frame.groupby("width").indices.items():
                matrix = np.array([frame["vector"].iat[i] for i in at], np.float64).reshape(len(at), width)
                packed = _packed(summaries(matrix), len(at))
                for i, values in zip(at, packed):
                    out[i] = values
            yield frame.assign(summary=out)

    return stored(rows.mapInPandas(summarise, f"{rows.schema.simpleString()[7:-1]},summary array<double>"), "summaries")


def _arrays(frame: pd.DataFrame) -> dict:
    width = int(frame["width"].iat[0]) if len(frame) else 0
    vector = np.array(frame["vector"].tolist(), np.int64).reshape(len(frame), width)
    packed = np.array(frame["summary"].tolist(), np.float64).reshape(len(frame), -1)
    return {
        "row": frame["row"].to_numpy(np.int64),
        "id": frame["vec_id"].to_numpy(np.int64),
        "unknown": (~frame["known"].astype(bool)).to_numpy(),
        "label": frame["label"].to_numpy(np.int64),
        "vector": vector,
        "summary": _unpacked(packed, width),
    }


def _windows(frame: pd.DataFrame, floor: int, ceiling: int) -> tuple[np.ndarray, np.ndarray]:
    """From each positive's score the allowed scores: floor to ceiling percent of it."""
    scores = [[int(s) for s in row] for row in frame["scores"]]
    widest = max(map(len, scores), default=0)
    low = np.full((len(scores), widest), LONG.max)
    high = np.full((len(scores), widest), LONG.min)
    for i, row in enumerate(scores):
        low[i, : len(row)] = [-(-floor * s // 100) for s in row]
        high[i, : len(row)] = [ceiling * s // 100 for s in row]
    return low, high


def _in_cells(anchors: DataFrame, rows: DataFrame, by: list[str], work) -> DataFrame:
    """Every block of anchors with every block of rows of the same ``by``."""
    of_rows = rows.groupBy(*by).agg(F.ceil(F.count("*") / ROWS_A_CELL).cast("int").alias("r_blocks"))
    of_anchors = anchors.groupBy(*by).agg(F.ceil(F.count("*") / ANCHORS_A_CELL).cast("int").alias("a_blocks"))
    # Written first, so that the joins below have no aggregate under them and a hot key can be split.
    blocks = stored(of_rows.join(of_anchors, by), "blocks")

    def spread(table: DataFrame, own: str, other: str) -> DataFrame:
        return (
            table.join(blocks, by)
            .withColumn(own, F.pmod(F.xxhash64("row"), F.col(f"{own}_blocks")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)))
            .drop("r_blocks", "a_blocks")
        )

    cell = [*by, "a", "r"]
    return spread(anchors, "a", "r").groupBy(*cell).cogroup(spread(rows, "r", "a").groupBy(*cell)).applyInPandas(work, FOUND)


def _found(asked: pd.DataFrame, held: np.ndarray, windows: int) -> pd.DataFrame:
    at, place = held[:, 0] // max(windows, 1), held[:, 0] % max(windows, 1)

    def listed(name, kind):
        return np.array([asked[name].iat[i][p] for i, p in zip(at, place)], kind)

    with_positives = "scores" in asked
    return pd.DataFrame(
        {
            "anchor": asked["row"].to_numpy(np.int64)[at],
            "anchor_id": asked["vec_id"].to_numpy(np.int64)[at],
            "place": place.astype(np.int32),
            "positive_id": listed("ids", np.int64) if with_positives else np.zeros(len(held), np.int64),
            "positive_known": listed("knowns", bool) if with_positives else np.zeros(len(held), bool),
            "positive_score": listed("scores", np.int64) if with_positives else np.zeros(len(held), np.int64),
            "row": held[:, 4],
            "vec_id": held[:, 3],
            "known": held[:, 2] == 0,
            "score": held[:, 1],
        }
    )


def _ranked(found: DataFrame, k: int, *slot: str) -> DataFrame:
    order = Window.partitionBy(*slot).orderBy(F.desc("score"), F.desc("known"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def positives_of(rows: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """Of every anchor its ``k`` best other rows of the same label, with rank; columns as in FOUND."""

    def work(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        low = np.full((len(asked), 1), LONG.min)
        got = mined(_arrays(asked), _arrays(held), low, np.full_like(low, LONG.max), k, True) if len(asked) and len(held) else np.zeros((0, 5), np.int64)
        return _found(asked, got, 1)

    columns = ["row", "vec_id", "known", "label", "vector", "summary", "width"]
    found = _in_cells(anchors.select(*columns), rows.select(*columns), ["width", "label"], work)
    return _ranked(found, k, "anchor")


def hard_negatives(
    vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, floor: int = 50, ceiling: int = 95,
    vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``; positives their best
    other rows of the same label; negatives, by anchor and positive, the best rows
    of other labels whose score is between ``floor`` and ``ceiling`` percent of the
    positive's. See ``prepared`` for the labels and integer vectors, and for the
    rows that take no part. Ties go to the smaller id. Rows with a null id are no
    anchors but are found by others, after all known ids. Rows with a repeated id
    are rows of their own. Rows of different widths do not meet; vectors without
    components score 0. An anchor without positives, or a positive without
    negatives, has no row. No rows: no rows.
    """
    rows = prepared(vectors, vec_id, embedding, label)
    anchors = stored(rows.where(F.col("known") & (F.col("vec_id") % every == 0)), "anchors")
    best = stored(positives_of(rows, anchors, positives), "positives")
    of = best.groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("rank", "vec_id", "known", "score"))).alias("best")
    )
    asked = anchors.join(of, F.col("row") == F.col("anchor")).select(
        *anchors.columns,
        F.col("best.vec_id").alias("ids"), F.col("best.known").alias("knowns"), F.col("best.score").alias("scores"),
    )

    def work(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        low, high = _windows(asked, floor, ceiling)
        got = mined(_arrays(asked), _arrays(held), low, high, negatives, False) if len(asked) and len(held) else np.zeros((0, 5), np.int64)
        return _found(asked, got, low.shape[1])

    found = _in_cells(stored(asked, "asked"), rows, ["width"], work)
    return _ranked(found, negatives, "anchor", "place").select(
        "anchor_id",
        F.when(F.col("positive_known"), F.col("positive_id")).alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.when(F.col("known"), F.col("vec_id")).alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


NEGATIVES_SQL = """
with r as (
  select row_number() over (order by vec_id) as row, vec_id,
    case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select a.row as anchor, a.vec_id as anchor_id, a.label as anchor_label, b.row, b.vec_id, b.label,
    cast(coalesce(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])), 0) as bigint) as score
  from r a join r b on a.row <> b.row and len(a.v) = len(b.v)
  where a.vec_id % 50 = 0
), p as (
  select anchor, anchor_id, row as positive, vec_id as positive_id, score as positive_score
  from s where label = anchor_label
  qualify row_number() over (partition by anchor order by score desc, vec_id nulls last, row) <= 5
)
select p.anchor_id, p.positive_id,
  cast(row_number() over (partition by p.anchor, p.positive order by s.score desc, s.vec_id nulls last, s.row) as integer) as rank,
  s.vec_id as negative_id, p.positive_score, s.score as negative_score
from p join s on p.anchor = s.anchor and s.label <> s.anchor_label
  and 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score
qualify row_number() over (partition by p.anchor, p.positive order by s.score desc, s.vec_id nulls last, s.row) <= 3
"""
