import math

import numpy as np
import pytest

from shelfmark.llm import ann
from shelfmark.llm.ann import CentroidGraph, lists_within, nearest

SCHEMA = "vec_id long, embedding array<float>, rank int, score string"


def brute_force(rows, k=20):
    """(query row, its neighbours' ids and scores) over the vectors that take part."""
    used = [
        (i, v) for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    width = max((len(v) for _, v in used), key=lambda w: ([len(v) for _, v in used].count(w), w), default=0)
    used = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in used if len(v) == width]
    out = []
    for at, (i, q) in enumerate(used):
        if i % 20 == 0:
            others = [(-(q * v).sum(), j) for n, (j, v) in enumerate(used) if n != at]
            out.append((i, [(j, -s) for s, j in sorted(others)[:k]]))
    return out


def recall(got, wanted):
    per_query = {}
    for r in got:
        per_query.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for query, near in wanted:
        rows = sorted(per_query.get(query, []))
        assert [r[0] for r in rows] == list(range(1, len(near) + 1))
        order = [(-r[2], r[1]) for r in rows]
        assert order == sorted(order)
        hits += len({j for j, _ in near} & {r[1] for r in rows})
        total += len(near)
    return hits / total


def test_recall_on_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding").collect()]
    wanted = brute_force(rows)
    got = nearest(table).collect()
    assert len({r["query_id"] for r in got}) == len(wanted)
    assert recall(got, wanted) >= 0.9
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    for r in got[:200]:
        assert r["score"] == pytest.approx(float((vectors[r["query_id"]] * vectors[r["vec_id"]]).sum()), abs=1e-12)


def test_vectors_of_any_length_and_a_hot_vector(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.1, 5)).astype(np.float32).tolist(), 1, "s") for i in range(900)]
    hot = rows[40][1]
    rows += [(2000 + i, hot, 1, "s") for i in range(500)]
    got = nearest(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()
    wanted = brute_force(rows)
    assert recall(got, wanted) >= 0.9
    mine = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == 40)
    best = dict(wanted)[40]
    tied = [j for j, s in best if s == best[0][1]]
    assert [j for _, j in mine][: len(tied)] == tied


def test_what_takes_no_part_and_fewer_candidates_than_asked(spark):
    good = [(20 * i, [float(i + 1), 1.0, 0.5], 1, "s") for i in range(5)]
    bad = [
        (100, None, 1, "s"), (120, [], 1, "s"), (140, [0.0, 0.0, 0.0], 1, "s"), (160, [1.0, None, 1.0], 1, "s"),
        (180, [float("nan"), 1.0, 1.0], 1, "s"), (200, [float("inf"), 1.0, 1.0], 1, "s"), (None, [1.0, 1.0, 1.0], 1, "s"),
        (220, [1.0, 1.0], 1, "s"),
    ]
    got = nearest(spark.createDataFrame(good + bad, SCHEMA)).collect()
    assert recall(got, brute_force(good + bad)) == 1
    assert len(got) == 5 * 4
    repeated = nearest(spark.createDataFrame(good[:1] * 2, SCHEMA)).collect()
    assert [(r["query_id"], r["vec_id"], r["rank"]) for r in repeated] == [(0, 0, 1), (0, 0, 1)]


def test_one_vector_and_none(spark):
    assert nearest(spark.createDataFrame([(0, [1.0], 1, "s")], SCHEMA)).count() == 0
    assert nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_lists_are_cut_into_blocks(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_VECTORS", 7)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 3)
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding").collect()]
    assert recall(nearest(table).collect(), brute_force(rows)) >= 0.9


def test_the_graph_walk_finds_the_nearest_centroids():
    rng = np.random.default_rng(2)
    centroids = rng.normal(size=(300, 6))
    graph = CentroidGraph.of(centroids)
    points = rng.normal(size=(50, 6))
    true = np.sqrt(((points[:, None] - centroids) ** 2).sum(2))
    met = graph.search(points, 0.3)
    assert (met.argmin(1) == true.argmin(1)).mean() >= 0.98
    rows, at = lists_within(met, 0.3)
    wanted = {tuple(x) for x in np.argwhere(true <= true.min(1, keepdims=True) * 1.3).tolist()}
    assert len(wanted & set(zip(rows.tolist(), at.tolist()))) >= 0.95 * len(wanted)
    far = lists_within(graph.search(points, math.inf), math.inf)
    assert len(far[0]) == 50 * 300


@pytest.mark.parametrize("copies", [2, 5])
def test_copies_at_a_centroid_get_all_candidates(spark, copies):
    """Few distinct vectors of equal norm: a centroid is a vector, at distance 0 from its copies."""
    rows = [(20 * i, v, 1, "s") for i, v in enumerate([[1.0, 0.0]] * copies + [[0.0, 1.0]] * copies)]
    got = nearest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert recall(got, brute_force(rows)) == 1
    assert len(got) == len(rows) * (len(rows) - 1)
