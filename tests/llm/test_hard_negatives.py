import math
import random

import numpy as np
import pytest

from shelfmark.llm import hard_negatives as hn
from shelfmark.llm.hard_negatives import Best, hard_negatives, mined, products, summaries

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score int"


def brute(rows, every=50, positives=5, negatives=3):
    """By all pairs, in Python integers."""
    kept = []
    for place, (vec_id, embedding, label) in enumerate(rows):
        if label is None or embedding is None or any(v is None or not math.isfinite(v) for v in embedding):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        kept.append((place, vec_id, label, [math.floor(256 * float(v)) for v in embedding]))
    out = []

    def order(r):
        return -r[1], r[0] is None, r[0] or 0

    for place, vec_id, label, v in kept:
        if vec_id is None or vec_id % every:
            continue
        others = [
            (i, sum(a * b for a, b in zip(v, w)), l) for p, i, l, w in kept if p != place and len(w) == len(v)
        ]
        best = sorted((o for o in others if o[2] == label), key=order)[:positives]
        for p_id, p_score, _ in best:
            fit = [o for o in others if o[2] != label and 50 * p_score <= 100 * o[1] <= 95 * p_score]
            for rank, (n_id, n_score, _) in enumerate(sorted(fit, key=order)[:negatives], 1):
                out.append((vec_id, p_id, rank, n_id, p_score, n_score))
    return sorted(out, key=str)


def mine(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in hard_negatives(df, **options).collect()), key=str)


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(1)
    for width in (1, 3, 16, 64, 70):
        a, x = (np.floor(256 * rng.normal(0.1, 0.4, (40, width))) for _ in range(2))
        exact, before = a @ x.T, None
        for (am, ar), (xm, xr) in zip(summaries(a), summaries(x)):
            middle, spread = am @ xm.T, ar @ xr.T
            assert (np.abs(exact - middle) <= spread + 1e-6).all()
            if before is not None:
                assert (spread <= before + 1e-6).all()
            before = spread
        if width <= 16:
            assert np.abs(before).max() < 1e-6  # segments of one component


def test_pairs_are_left_out_by_bounds_alone(monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 1, (20, 8)).repeat(8, axis=1)
    x = np.floor(40 * (centres.repeat(300, axis=0) + 0.1 * rng.normal(size=(6000, 64)))).astype(np.int64)
    scored = []
    monkeypatch.setattr(hn, "products", lambda a, b: scored.append(len(a) * len(b)) or products(a, b))
    side = {
        "row": np.arange(6000), "id": np.arange(6000), "unknown": np.zeros(6000, bool),
        "label": np.zeros(6000, np.int64), "vector": x, "summary": summaries(x.astype(float)),
    }
    few = {k: v[:50] if k != "summary" else [(m[:50], d[:50]) for m, d in v] for k, v in side.items()}
    low = np.full((50, 1), hn.LONG.min)
    held = mined(few, side, low, np.full_like(low, hn.LONG.max), 5, True)
    exact = x[:50] @ x.T
    exact[np.arange(50), np.arange(50)] = hn.LONG.min
    for i in range(50):
        best = sorted((-int(s), j) for j, s in enumerate(exact[i]) if j != i)[:5]
        assert [(-r[1], r[3]) for r in held if r[0] == i] == [(s, j) for s, j in best]
    assert sum(scored) < 0.5 * 50 * 6000


def test_products_are_exact_at_any_size():
    for most in (1 << 10, 1 << 28, 1 << 40):
        rng = random.Random(most)
        a, x = ([[rng.randint(-most, most) for _ in range(5)] for _ in range(7)] for _ in range(2))
        exact = [[max(-(1 << 63), min((1 << 63) - 1, sum(p * q for p, q in zip(u, v)))) for v in x] for u in a]
        assert products(np.array(a), np.array(x)).tolist() == exact


def test_the_best_are_kept_in_order():
    best = Best(np.array([[5, -5]]), 2)
    best.add([0, 0, 1], [7, 9, 3], [0, 0, 1], [4, 3, 0], [0, 1, 2])
    best.add([0, 1, 1], [9, 3, 3], [0, 0, 0], [2, 9, 8], [3, 4, 5])
    assert best.held[:, [0, 1, 3]].tolist() == [[0, 9, 2], [0, 9, 3], [1, 3, 8], [1, 3, 9]]
    assert best.least.tolist() == [[9, 3]]


@pytest.mark.parametrize("blocks", [(2048, 1 << 14), (3, 40)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(hn, "ANCHORS_A_CELL", blocks[0])
    monkeypatch.setattr(hn, "ROWS_A_CELL", blocks[1])
    monkeypatch.setattr(hn, "AT_ONCE", 16)
    rng = random.Random(4)
    rows = []
    for i in range(260):
        centre = i % 9
        rows.append((i, [rng.gauss(0.3 if d % 9 == centre else 0, 0.1) for d in range(12)], rng.randrange(3)))
    rows = [(i, np.float32(v).tolist(), label) for i, v, label in rows]
    got = mine(spark, rows, every=10)
    assert got == brute(rows, every=10) and len(got) > 100


def test_the_given_table(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [tuple(r) for r in vectors.select("vec_id", "embedding", "label").collect()]
    got = sorted((tuple(r) for r in hard_negatives(vectors).collect()), key=str)
    assert got == brute(rows) and got


def test_nulls_ties_repeats_widths_and_no_rows(spark):
    one, half = [1.0, 0.5], [0.7, 0.3]
    rows = [
        (0, one, 1), (0, one, 1), (1, one, 1), (1, one, 1), (None, one, 1), (None, half, 2), (3, half, 2), (3, half, 2),
        (4, half, 3), (5, None, 2), (6, [None, 1.0], 2), (8, [float("nan"), 1.0], 2), (9, [float("inf"), 1.0], 2),
        (10, half, None), (50, [1.0], 1), (51, [2.0], 1), (52, [1.5], 2), (100, [], 1), (101, [], 1), (102, [], 4),
        (150, [1.0, -0.5], 8), (14, one, 0), (200, [0.0, 0.0], 6), (201, [0.0, 0.0], 6), (203, [0.0, 0.0], 7),
    ]
    assert mine(spark, rows) == brute(rows)
    assert mine(spark, []) == []
    alone = [(0, one, 1), (1, half, 2)]
    assert mine(spark, alone) == []


def test_large_components(spark):
    rows = [(i, [float(1 << 20) * (i % 5 + 1), 3.0], i % 2) for i in range(60)]
    assert mine(spark, rows) == brute(rows)
    huge = [(i, [1e30, 1.0], i % 2) for i in range(3)]
    assert {r[4] for r in mine(spark, huge)} <= {(1 << 63) - 1}


def test_one_label_of_most_rows_is_dealt_to_many_cells(spark, monkeypatch):
    monkeypatch.setattr(hn, "ROWS_A_CELL", 50)
    rng = random.Random(6)
    rows = [(i, np.float32([rng.gauss(0, 0.2) for _ in range(4)]).tolist(), int(i % 10 == 0)) for i in range(400)]
    assert mine(spark, rows) == brute(rows)
