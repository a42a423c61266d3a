"""Nearest neighbours by inner product, from balanced posting lists.

Index: the largest inner product is turned into the least distance by one more
component, sqrt(M^2 - |x|^2), M being the largest norm. A bounded sample of
distinct vectors is halved again and again at the median of its main direction;
the means of the equal parts are the centroids, moved to the means of what is
nearest to them a few times. Every vector is put into the list of its nearest
centroid and, where it lies near a border, into that of the next one too if its
distance is within a ratio of the least.

Search: the centroids are searched by a best-first walk over an in-memory graph
of their neighbours, which ends when the nearest centroid not yet expanded is
farther than a ratio of the nearest found. All lists within the ratio are read.
The ratio is the least that gives the recall asked for on the sample: the share
of near vectors is known for every ratio from how far the lists they are in are.

A query's nearest lists are read first. The k-th best score found there is a floor
for all its other lists: these give only candidates that reach it, so a query gets
few candidates however many lists it reads. Lists are joined to their queries in
blocks of bounded size; a list of any length is many blocks, and every block gives
each of its queries at most k candidates, with exact scores.
"""

from __future__ import annotations

import math
import pickle
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import stored

SAMPLE_ROWS = 20_000
MOST_LISTS = 4096
LINKS = 16
REPLICAS = 2
BORDER = 0.05
RECALL = 0.95
ROUNDS = 3
FIRST_LISTS = 3
TEST_QUERIES = 256
BLOCK_VECTORS = 8192
BLOCK_QUERIES = 4096


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(row, vec_id, vector) of the vectors that take part, stored.

    Left out: null ids and vectors; vectors that are zero or hold null, NaN or
    infinite components; vectors of another length than most have. Rows are told
    apart by ``row``, so repeated ids are vectors of their own.
    """
    cast = F.transform(F.col(embedding), lambda x: x.cast("double"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), cast.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & fine & F.exists("vector", lambda x: x != 0)
    )
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()).withColumn("width", F.size("vector")), "vectors")
    width = rows.groupBy("width").count().orderBy(F.desc("count"), F.desc("width")).first()
    return rows.where(F.col("width") == (width["width"] if width else 0)).drop("width")


def _distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    squares = (points**2).sum(1)[:, None] - 2 * points @ centroids.T + (centroids**2).sum(1)
    return np.sqrt(np.maximum(squares, 0))


def _halved(points: np.ndarray, parts: int) -> list[np.ndarray]:
    """Equal parts of the points, each cut at the median along its main direction."""
    if parts <= 1 or len(points) <= 1:
        return [points.mean(axis=0)]
    centred = points - points.mean(axis=0)
    direction = centred[np.argmax((centred**2).sum(1))]
    for _ in range(8):
        direction = centred.T @ (centred @ direction)
        direction = direction / (np.linalg.norm(direction) + 1e-300)
    order = np.argsort(centred @ direction, kind="stable")
    left = parts // 2
    cut = min(max(1, len(points) * left // parts), len(points) - 1)
    return _halved(points[order[:cut]], left) + _halved(points[order[cut:]], parts - left)


def _refined(centroids: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Centroids moved to the means of the points nearest to them; one without points stays."""
    for _ in range(ROUNDS):
        at = np.concatenate([_distances(points[i : i + 1024], centroids).argmin(axis=1) for i in range(0, len(points), 1024)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, at, points)
        held = np.bincount(at, minlength=len(centroids))
        centroids = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centroids)
    return centroids


class CentroidGraph:
    """Centroids, each linked to its nearest ones; links go both ways."""

    def __init__(self, centroids: np.ndarray, links: np.ndarray, entries: np.ndarray):
        self.centroids, self.links, self.entries = centroids, links, entries

    @classmethod
    def of(cls, centroids: np.ndarray) -> CentroidGraph:
        n = len(centroids)
        near = np.empty((n, min(LINKS, n - 1)), np.int64)
        for start in range(0, n, 512):
            d = _distances(centroids[start : start + 512], centroids)
            d[np.arange(len(d)), np.arange(start, start + len(d))] = np.inf
            near[start : start + 512] = np.argsort(d, axis=1, kind="stable")[:, : near.shape[1]]
        links: list[set[int]] = [set(row) for row in near.tolist()]
        for i, row in enumerate(near.tolist()):
            for j in row:
                links[j].add(i)
        # A ring joins what the nearest links leave apart.
        for i in range(n):
            links[i].add((i + 1) % n)
        widest = max(map(len, links))
        table = np.full((n, widest), -1, np.int64)
        for i, row in enumerate(links):
            table[i, : len(row)] = sorted(row)
        return cls(centroids, table, np.unique(np.linspace(0, n - 1, max(1, math.isqrt(n))).astype(np.int64)))

    def search(self, points: np.ndarray, ratio: float, least: int = 8) -> np.ndarray:
        """Distances from each point to the centroids that the walk met, infinite for others.

        Of every point the nearest open centroid is expanded, as long as it is
        within ``ratio`` of the nearest met or among the ``least`` nearest. With an
        infinite ratio all centroids are met.
        """
        n, k = len(points), len(self.centroids)
        met = np.full((n, k), np.inf)
        met[:, self.entries] = _distances(points, self.centroids[self.entries])
        closed = np.zeros((n, k), bool)
        active = np.arange(n)
        while len(active):
            here = met[active]
            open_ = np.where(closed[active], np.inf, here)
            at = open_.argmin(axis=1)
            best = open_[np.arange(len(active)), at]
            bound = here.min(axis=1) * (1 + ratio) if math.isfinite(ratio) else np.full(len(active), np.inf)
            if k > least:
                bound = np.maximum(bound, np.partition(here, least, axis=1)[:, least])
            more = (best <= bound) & np.isfinite(best)
            active, at = active[more], at[more]
            if not len(active):
                break
            closed[active, at] = True
            around = self.links[at]
            diff = points[active][:, None, :] - self.centroids[around]
            far = np.sqrt((diff**2).sum(axis=2))
            rows = np.repeat(active, around.shape[1])
            valid = (around >= 0).ravel()
            met[rows[valid], around.ravel()[valid]] = far.ravel()[valid]
        return met


def lists_within(met: np.ndarray, ratio: float, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(point, list) for the lists within ``ratio`` of the nearest, the ``most`` nearest if given.

    With an infinite ratio all lists that were met, also for a point at distance 0 from one.
    """
    if math.isfinite(ratio):
        within = met <= met.min(axis=1, keepdims=True) * (1 + ratio) + 1e-12
    else:
        within = np.isfinite(met)
    if most and most < met.shape[1]:
        within &= met <= np.partition(met, most - 1, axis=1)[:, most - 1 : most]
    return np.nonzero(within)


def fit(sample: np.ndarray, largest: float, lists: int, k: int) -> dict:
    """Graph, border and search ratio, fitted on a sample of vectors."""
    points = _augmented(sample, largest)
    points = points[np.sort(np.unique(points, axis=0, return_index=True)[1])]
    graph = CentroidGraph.of(_refined(np.array(_halved(points, min(lists, len(points)))), points))
    rng = np.random.default_rng(3)
    tests = rng.permutation(len(points))[:TEST_QUERIES]
    belongs = np.zeros((len(points), len(graph.centroids)), bool)
    for start in range(0, len(points), 1024):
        rows, at = lists_within(graph.search(points[start : start + 1024], BORDER), BORDER, REPLICAS)
        belongs[start + rows, at] = True
    asked = points[tests].copy()
    asked[:, -1] = 0
    scores = asked[:, :-1] @ points[:, :-1].T
    scores[np.arange(len(tests)), tests] = -np.inf
    wanted = np.argsort(-scores, axis=1)[:, : min(k, len(points) - 1)]
    wanted = wanted if wanted.shape[1] else tests[:, None]
    # How far beyond the nearest list the nearest one with the wanted vector is.
    far = graph.search(asked, math.inf)
    needed = np.array([np.where(belongs[w], d, np.inf).min(axis=1) for w, d in zip(wanted, far)])
    apart = far.min(axis=1) > 1e-9  # at a centroid no ratio tells lists apart
    needed = np.sort((needed[apart] / far.min(axis=1)[apart, None] - 1).ravel())
    ratio = needed[min(len(needed) - 1, math.ceil(RECALL * len(needed)))] + 1e-9 if len(needed) else math.inf
    while True:  # the walk may pass some lists by
        rows, at = lists_within(graph.search(asked, ratio), ratio)
        read = np.zeros((len(tests), len(graph.centroids)), bool)
        read[rows, at] = True
        found = [(belongs[w] & r).any(axis=1).mean() for w, r in zip(wanted, read)]
        if np.mean(found) >= RECALL or ratio > 1e6:
            break
        ratio *= 1.1
    return {"graph": vars(graph), "ratio": ratio, "largest": largest}


def _augmented(vectors: np.ndarray, largest: float) -> np.ndarray:
    vectors = vectors / largest
    rest = np.sqrt(np.maximum(1 - (vectors**2).sum(axis=1), 0))
    return np.column_stack([vectors, rest])


def _matrix(column) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), -1)


def index_of(vectors: DataFrame, k: int, sample_rows: int = SAMPLE_ROWS) -> dict | None:
    """The model fitted in one task on at most about ``sample_rows`` vectors; None without vectors."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    n, largest = vectors.agg(F.count("*"), F.max(norm)).first()
    if not n:
        return None
    lists = max(1, min(MOST_LISTS, math.isqrt(n)))
    draw = F.pmod(F.xxhash64("row", "vec_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = vectors.where(draw < min(1.0, sample_rows / n)).select("row", "vector")

    def train(frames):
        got = pd.concat(list(frames), ignore_index=True)
        if len(got):
            got = got.sort_values("row", kind="stable")
            model = fit(_matrix(got["vector"]), largest, lists, k)
            yield pd.DataFrame({"model": [zlib.compress(pickle.dumps(model), 1)]})

    found = sample.repartition(1).mapInPandas(train, "model binary").collect()
    if not found:  # a sample of few vectors may be empty
        found = vectors.limit(min(n, sample_rows)).select("row", "vector").repartition(1).mapInPandas(train, "model binary").collect()
    return pickle.loads(zlib.decompress(found[0]["model"]))


def _listed(vectors: DataFrame, model: dict, query: bool) -> DataFrame:
    """(list, row, vec_id, vector) for the lists that a vector is in, or that a query reads.

    ``place`` is that of the list among those of the vector or query, nearest first.
    """

    def assign(frames):
        graph = CentroidGraph(**model["graph"])
        for frame in frames:
            for start in range(0, len(frame), 512):
                some = frame.iloc[start : start + 512]
                points = _augmented(_matrix(some["vector"]), model["largest"])
                if query:
                    points[:, -1] = 0
                    met = graph.search(points, model["ratio"])
                    rows, at = lists_within(met, model["ratio"])
                else:
                    met = graph.search(points, BORDER)
                    rows, at = lists_within(met, BORDER, REPLICAS)
                place = np.argsort(np.argsort(met, axis=1, kind="stable"), axis=1)[rows, at]
                yield some.iloc[rows].assign(list=at.astype(np.int32), place=place.astype(np.int32))

    return vectors.mapInPandas(assign, "row long, vec_id long, vector array<double>, list int, place int")


def nearest(
    vectors: DataFrame, k: int = 20, every: int = 20, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each query, nearest first.

    Queries are the vectors whose id is divisible by ``every``; candidates all
    but the query's own row. Scores are inner products in double precision, ties
    go to the smaller id. All candidates where there are fewer than ``k``. See
    ``usable`` for the vectors that take no part.
    """
    rows = usable(vectors, vec_id, embedding).select("row", "vec_id", "vector")
    model = index_of(rows, k)
    if model is None:
        return rows.select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        ).limit(0)
    postings = stored(_listed(rows, model, False).drop("place"), "postings")
    asked = rows.where(F.col("vec_id") % every == 0)
    probes = stored(_listed(asked, model, True), "probes")
    no_floor = F.lit(-math.inf)
    first = probes.where(F.col("place") < FIRST_LISTS).withColumn("floor", no_floor)
    first = stored(_candidates(first, postings, k), "first")
    floors = _ranked(first, k).where(F.col("rank") == k).select("query_row", F.col("score").alias("floor"))
    rest = probes.where(F.col("place") >= FIRST_LISTS).join(floors, F.col("row") == F.col("query_row"), "left")
    rest = rest.drop("query_row").withColumn("floor", F.coalesce("floor", no_floor))
    found = stored(_ranked(first.unionByName(_candidates(stored(rest, "rest"), postings, k)), k), "found")
    # Lists may hold fewer than k candidates together; such queries read all lists.
    wanted = min(k, rows.count() - 1)
    served = found.groupBy("query_row").count().where(F.col("count") >= wanted)
    short = stored(asked.join(served, F.col("row") == F.col("query_row"), "left_anti"), "short") if wanted else asked.limit(0)
    if wanted and short.count():
        all_lists = stored(_listed(short, model | {"ratio": math.inf}, True).withColumn("floor", no_floor), "all-lists")
        everywhere = _ranked(_candidates(all_lists, postings, k), k)
        again = short.select(F.col("row").alias("again"))
        found = found.join(again, F.col("query_row") == F.col("again"), "left_anti").unionByName(everywhere)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _compared(k: int):
    def compare(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        """The k best of the held vectors for each query, as far as they reach its floor."""
        out = []
        if len(asked) and len(held):
            q, x = _matrix(asked["vector"]), _matrix(held["vector"])
            floor = asked["floor"].to_numpy(np.float64)
            rows, ids = held["row"].to_numpy(), held["vec_id"].to_numpy()
            slack = 1e-9 * float(np.abs(q).max() * np.abs(x).max()) * q.shape[1]
            for start in range(0, len(q), 256):
                rough = q[start : start + 256] @ x.T
                if len(x) > k + 1:  # one more, as the query itself may be among them
                    bound = np.partition(rough, len(x) - k - 1, axis=1)[:, len(x) - k - 1] - slack
                else:
                    bound = np.full(len(rough), -np.inf)
                bound = np.maximum(bound, floor[start : start + 256] - slack)
                for i in range(len(rough)):
                    own = asked["row"].iat[start + i]
                    near = np.flatnonzero(rough[i] >= bound[i])
                    near = near[rows[near] != own]
                    # Summed alike for all, so that equal vectors tie exactly.
                    exact = (x[near] * q[start + i]).sum(axis=1)
                    best = np.lexsort((rows[near], ids[near], -exact))[:k]
                    best = best[exact[best] >= floor[start + i]]
                    out.append((own, asked["vec_id"].iat[start + i], rows[near][best], ids[near][best], exact[best]))
        sizes = [len(o[2]) for o in out]
        return pd.DataFrame(
            {
                "query_row": np.repeat(np.array([o[0] for o in out], np.int64), sizes),
                "query_id": np.repeat(np.array([o[1] for o in out], np.int64), sizes),
                "row": np.concatenate([o[2] for o in out]) if out else np.zeros(0, np.int64),
                "vec_id": np.concatenate([o[3] for o in out]) if out else np.zeros(0, np.int64),
                "score": np.concatenate([o[4] for o in out]) if out else np.zeros(0),
            }
        )

    return compare


def _candidates(probes: DataFrame, postings: DataFrame, k: int) -> DataFrame:
    """query_row, query_id, row, vec_id, score from the lists that the probes read; replicas show more than once."""
    # One row for each list, at most MOST_LISTS.
    v_blocks = postings.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("v_blocks"))
    q_blocks = probes.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("q_blocks"))
    blocks = F.broadcast(stored(v_blocks.join(q_blocks, "list"), "lists"))

    def spread(table, own, other, *more):
        return (
            table.join(blocks, "list")
            .withColumn(own, F.pmod(F.xxhash64("row"), F.col(f"{own}_blocks")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)))
            .select("list", "v", "q", "row", "vec_id", "vector", *more)
        )

    asked = spread(probes, "q", "v", "floor").groupBy("list", "v", "q")
    held = spread(postings, "v", "q").groupBy("list", "v", "q")
    return asked.cogroup(held).applyInPandas(
        _compared(k), "query_row long, query_id long, row long, vec_id long, score double"
    )


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query with their rank; replicas, which sort next to each other, count once."""
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    before = F.lag("row").over(best)
    once = found.withColumn("before", before).where(F.col("before").isNull() | (F.col("before") != F.col("row")))
    return once.drop("before").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
