import heapq
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.llm.mixing import apportion, mix, mixed, targets


def sainte_lague(votes, seats):
    """One seat after the other to the highest quotient; ties to the first."""
    won = [0] * len(votes)
    heap = [(-v, i) for i, v in enumerate(votes) if v > 0]
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, i = heapq.heappop(heap)
        won[i] += 1
        heapq.heappush(heap, (-(votes[i] / (2 * won[i] + 1)), i))
    return won


def water_filled(sizes, weights, total):
    got = {}
    while True:
        left = total - sum(got.values())
        open_ = [i for i in range(len(sizes)) if i not in got]
        level = left / sum(weights[i] for i in open_) if open_ else 0
        over = [i for i in open_ if level * weights[i] >= 2 * sizes[i]]
        if not over:
            return [got.get(i, level * weights[i]) for i in range(len(sizes))]
        got |= {i: 2.0 * sizes[i] for i in over}


def test_apportionment_equals_seat_by_seat(spark):
    random.seed(6)
    cases = [([random.randint(0, 1000) for _ in range(random.randint(1, 12))], random.randint(0, 90)) for _ in range(25)]
    cases += [([5, 5, 5, 5], 6), ([1, 1000], 3), ([0, 0], 4), ([7], 9), ([1] * 30, 7)]
    rows = [(c, i, v, s) for c, (votes, s) in enumerate(cases) for i, v in enumerate(votes)]
    parties = spark.createDataFrame(rows, "c int, i int, v long, s long")
    got = {(r["c"], r["i"]): r["quota"] for r in apportion(parties, "v", "i", "s", "c").collect()}
    for c, (votes, seats) in enumerate(cases):
        assert [got[c, i] for i in range(len(votes))] == sainte_lague(votes, seats), (votes, seats)


def test_targets_are_filled_by_weight(spark):
    sizes = {"b": 100, "a": 1000, "é": 10, None: 400, "c": 0}
    rows = [(k, v) for k, v in sizes.items()]
    got = {r["source"]: r["target"] for r in targets(spark.createDataFrame(rows, "source string, source_size long")).collect()}
    order = ["a", "b", "c", "é", None]
    wanted = water_filled([sizes[s] for s in order], [5, 2, 1, 5, 2], 1.5 * 1510)
    assert [got[s] for s in order] == pytest.approx(wanted)
    assert sum(got.values()) == pytest.approx(1.5 * 1510)


def test_taken_words_follow_the_targets(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("w "), (F.col("id") % 37).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"),
    )
    rows = mixed(docs).collect()
    assert len(rows) == 6000
    taken, target = {}, {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    for s, t in target.items():
        assert taken[s] == pytest.approx(t, rel=0.01)
    again = mixed(docs.repartition(7)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in rows)


@pytest.mark.parametrize(
    "rows", [[], [(1, None, None, 1)], [(1, "a b", None, 2), (1, "a b", None, 2), (2, "", "x", 3), (None, " \t", "y", 4), (3, "é é z", "x", 5)]]
)
def test_nulls_repeats_and_clashing_columns(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int").withColumn("target", F.lit("t"))
    got = mixed(docs).collect()
    assert sorted((r["doc_id"] or -1, r["size"]) for r in got) == sorted((r[0] or -1, len((r[1] or "").encode().split())) for r in rows)
    out = mix(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        assert r["text"].encode().split()


def test_mix_repeats_whole_documents(spark):
    rows = [(i, "w " * 50, "small" if i < 20 else "large") for i in range(200)] + [(7, "w " * 50, "small")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix(docs)
    per_source = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()}
    wanted = {r["source"]: r["target"] / 50 for r in mixed(docs).select("source", "target").distinct().collect()}
    for s in wanted:
        assert per_source[s] == pytest.approx(wanted[s], abs=2)


def shares(docs):
    """Words of each source in the mix, and their targets."""
    words = F.regexp_count("text", F.lit(r"\S+"))
    got = {r["source"]: r["n"] for r in mix(docs).groupBy("source").agg(F.sum(words).alias("n")).collect()}
    return got, {r["source"]: r["target"] for r in mixed(docs).select("source", "target").distinct().collect()}


def test_documents_longer_than_the_quota_do_not_use_it_up(spark):
    """Each source has one document far longer than what the mix may take of it."""
    rows = []
    for s in range(6):
        rows += [(100 * s + i, "w " * (40 + i), f"s{s}") for i in range(60)]
        rows.append((100 * s + 99, "w " * 60_000, f"s{s}"))
    got, target = shares(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for s, wanted in target.items():
        # Whole passes take the long one; else the ordinary documents fill the quota as far as they go.
        ordinary = sum(40 + i for i in range(60))
        rest = wanted % (60_000 + ordinary)
        assert abs(got.get(s, 0) - wanted) <= max(100, rest - ordinary), s
        assert got.get(s, 0) >= min(wanted, ordinary) - 100


def test_a_source_of_one_document_is_within_it(spark):
    rows = [(i, "w " * 100, f"s{i % 5}") for i in range(2000)] + [(9999, "w " * 32_000, "s6")]
    got, target = shares(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for s, wanted in target.items():
        assert abs(got.get(s, 0) - wanted) <= (32_000 if s == "s6" else 100), s
    assert got["s6"] % 32_000 == 0 and abs(got["s6"] - target["s6"]) <= 16_000
