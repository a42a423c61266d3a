import hashlib
import random
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import exact_dedup as module
from shelfmark.llm.exact_dedup import COPIES, KEY, TIES, distinct_rows, duplicate_report, exact_dedup, grace_distinct

SCHEMA = "doc_id long, text string, lang string, keep_id string, copies int"


def normal(text):
    return (text or "").encode().lower()


@pytest.mark.parametrize("memory", [1 << 30, 20_000, 2_000])
def test_grace_table_spills_to_the_same_result(memory):
    random.seed(1)
    texts = [random.choice([None, "", "aB", "Ab", "c"]) for _ in range(3000)]
    texts = [t if t is None else t * random.randint(0, 3) + str(random.randint(0, 150)) for t in texts]
    ids = [random.choice([None, random.randint(0, 500)]) for _ in texts]
    batches = [
        pa.record_batch({"t": texts[i : i + 60], "r": pa.array(ids[i : i + 60], pa.int64()), "z": pa.array([0] * 60, pa.int64())})
        for i in range(0, 3000, 60)
    ]
    found = [row for b in grace_distinct(iter(batches), "t", "r", "z", memory) for row in b.to_pylist()]
    groups = defaultdict(list)
    for text, id_ in zip(texts, ids):
        groups[hashlib.sha256(normal(text)).digest()].append(-1 if id_ is None else id_)
    assert sorted((r[KEY], -1 if r["r"] is None else r["r"], r[COPIES], r[TIES]) for r in found) == sorted(
        (k, max(v), len(v), v.count(max(v))) for k, v in groups.items()
    )


def test_equal_hashes_of_different_contents_stay_apart():
    batch = pa.record_batch(
        {
            "t": ["x", "y", "X"],
            "r": pa.array([1, 2, 3], pa.int64()),
            "z": pa.array([0, 0, 0], pa.int64()),
            KEY: pa.array([b"k" * 32] * 3, pa.binary()),
            COPIES: pa.array([1, 1, 1], pa.int64()),
            TIES: pa.array([1, 1, 1], pa.int64()),
        }
    )
    (found,) = grace_distinct(iter([batch]), "t", "r", "z")
    assert sorted((r["t"], r["r"], r[COPIES]) for r in found.to_pylist()) == [("X", 3, 2), ("y", 2, 1)]


def test_report_on_nulls_ties_and_repeats(spark):
    rows = [
        (1, "A b", "en", "k", 1), (5, "a B", None, "k", 2), (5, "a b", "de", None, 3), (5, "a b", "de", None, 3),
        (2, None, "en", "k", 4), (3, "", None, None, None), (None, "only", None, None, None), (None, "Only", None, None, None),
        (7, "Ä", None, None, None), (8, "ä", None, None, None), (9, "x" * 300_000, None, None, None),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = duplicate_report(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert len(r["text_sha256"]) == 64
    by_key = defaultdict(list)
    for r in got:
        by_key[r["text_sha256"]].append(r)
    for members in by_key.values():
        assert sum(r["kept"] for r in members) == 1
        assert {r["group_size"] for r in members} == {len(members)}
        best = max((r["doc_id"] for r in members if r["doc_id"] is not None), default=None)
        assert {r["keep_id"] for r in members} == {best}
    assert sorted(len(m) for m in by_key.values()) == [1, 1, 1, 2, 2, 4]
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(r["doc_id"] for r in by_key[empty]) == [2, 3]


def test_dedup_keeps_whole_rows(spark):
    rows = [(1, "A", "en", "k", 1), (3, "a", None, "z", 2), (3, "a", None, "z", 2), (4, None, "x", None, 9), (2, "", "y", None, 8)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("tags", F.create_map(F.lit("a"), F.col("copies")))
    kept = exact_dedup(docs.repartition(3))
    assert kept.columns == docs.columns
    assert sorted(tuple(r)[:5] for r in kept.collect()) == [(3, "a", None, "z", 2), (4, None, "x", None, 9)]


def test_spilling_after_the_shuffle(spark):
    rows = spark.range(4000).select(
        F.concat(F.lit("Text number "), (F.col("id") % 700).cast("string")).alias("t"),
        F.col("id").alias("r"),
        F.lit(0).cast("long").alias("z"),
        F.struct("id", F.lit("x").alias("s")).alias("whole"),
    )
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(batch, 100)
    try:
        found = distinct_rows(rows.repartition(6), "t", "r", "z", memory=4000).collect()
    finally:
        spark.conf.unset(batch)
    assert len(found) == 700
    assert sum(r[COPIES] for r in found) == 4000
    assert all(r["r"] == r["whole"]["id"] >= 3300 for r in found)


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert duplicate_report(docs).count() == 0
    assert exact_dedup(docs).count() == 0


def test_a_third_of_the_rows_are_copies(spark):
    docs = spark.range(9000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("text")
    ).repartition(16)
    report = duplicate_report(docs)
    hot = report.where("group_size > 1")
    assert hot.count() == 3000
    assert [r["doc_id"] for r in hot.where("kept").collect()] == [8997]
    assert report.where("kept").count() == 6001


def test_a_hot_class_is_split_in_the_final_join(spark, conf):
    """Two thirds of the rows are one text, a tenth of them with the largest id; nothing is broadcast."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        adaptive__advisoryPartitionSizeInBytes="20k",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )
    docs = spark.range(60_000).select(
        F.when(F.col("id") % 10 == 0, F.lit(10**6)).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("text"),
    )
    report = duplicate_report(docs.repartition(16))
    rows = report.collect()
    hot = [r for r in rows if r["group_size"] > 1]
    assert len(rows) == 60_000 and len(hot) == 40_000
    assert [r["doc_id"] for r in hot if r["kept"]] == [10**6]
    assert "skew=true" in report._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("others", [0, 3])
def test_copies_of_a_long_text_keep_to_the_memory_limit(monkeypatch, others):
    """Every copy has a larger id than the last and takes its place; the places given up are freed."""
    held = []

    class Watched(module.ContentTable):
        def compact(self):
            super().compact()
            held.append(sum(b.nbytes for b in self.rows))

        def result(self):
            held.append(sum(b.nbytes for b in self.rows))
            return super().result()

    monkeypatch.setattr(module, "ContentTable", Watched)
    texts = [f"t{i} " for i in range(others)] + ["w " * 50_000] * 60
    batches = [pa.record_batch({"t": [t], "r": [i], "z": [i]}) for i, t in enumerate(texts)]
    found = [row for b in grace_distinct(iter(batches), "t", "r", "z", 1 << 20) for row in b.to_pylist()]
    assert sorted((r["r"], r[COPIES], r[TIES]) for r in found) == [*((i, 1, 1) for i in range(others)), (others + 59, 60, 1)]
    assert max(held) <= (1 << 20) + 200_000
