import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import warc
from shelfmark.llm.warc import (
    INDEX,
    LoserTree,
    archived,
    capture_records,
    merge_index,
    merged_runs,
    parsed_record,
    read_archives,
    record_bytes,
    write_archives,
)
from shelfmark.session import scratch_dir

SCHEMA = "page_id long, url string, html string, file string, digest int"
ROWS = [
    (1, "http://www.A.org/x?q=1#f", "same", "f", 1), (9, "https://a.org/x", "same", "f", 2), (4, None, "same", "f", 3),
    (2, "http://b.org", None, None, None), (3, "", "", None, None), (5, "c\r\nX: y", "é\r\n\r\nWARC/1.1\r\n", None, None),
    (6, "http://d/1", "twice", None, None), (6, "http://d/1", "twice", None, None),
    (None, "http://e", "no id", None, None), (7, "http://e", "no id", None, None), (8, "http://u@h:80/p", "z" * 300_000, None, None),
]


def expected(rows, least=0):
    keep = {}
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        if len(data) >= least:
            best = keep.get(data, None)
            keep[data] = page_id if best is None else max(best, page_id if page_id is not None else best)
    out, done = [], set()
    for page_id, _, html, *_ in sorted(rows, key=lambda r: -(r[0] if r[0] is not None else -1)):
        data = (html or "").encode()
        first = len(data) < least or (data not in done and page_id == keep[data])
        done.add(data)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "response" if first else "revisit", None if first else keep[data]))
    return sorted(map(repr, out))


def plain(df):
    return sorted(repr(tuple(r)[:5]) for r in df.collect())


@pytest.mark.parametrize("least", [0, 1, 5])
def test_pages_read_back(spark, least):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    assert plain(archived(pages, least_bytes=least)) == expected(ROWS, least)


def test_a_payload_with_very_many_revisits_is_split(spark, conf):
    """Two thirds of the pages have one payload; nothing is broadcast."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        adaptive__advisoryPartitionSizeInBytes="20k",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__coalescePartitions__enabled="false",
    )
    pages = spark.range(30_000).select(
        F.col("id").alias("page_id"),
        F.concat(F.lit("http://h/"), F.col("id").cast("string")).alias("url"),
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("html"),
    )
    records = capture_records(pages.repartition(16), F.lit("20200101000000"))
    rows = records.collect()
    assert len(rows) == 30_000
    assert sum(r["record_type"] == "revisit" and r["refers_to"] == 29_999 for r in rows) == 19_999
    assert "skew=true" in records._jdf.queryExecution().executedPlan().toString()


def test_table_reads_back_and_no_rows(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    assert plain(archived(pages)) == expected(rows)
    assert archived(pages.limit(0)).count() == 0


def test_payload_comes_back_and_url_keys(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    folder = scratch_dir(spark, "warc-test")
    runs = write_archives(capture_records(pages, F.lit("20200102030405")), folder)
    got = read_archives(merge_index(runs), folder, payload=True).collect()
    assert {r["payload"] for r in got if r["record_type"] == "response"} == {(r[2] or "").encode() for r in ROWS}
    assert all(r["payload"] == b"" for r in got if r["record_type"] == "revisit")
    keys = {r["page_id"]: r["url_key"] for r in got}
    assert keys[1] == "org,a)/x?q=1" and keys[9] == "org,a)/x" and keys[2] == "org,b)/" and keys[4] == ")/"


def test_files_are_cut_and_the_index_is_in_global_order(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 5_000)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").repartition(6)
    folder = scratch_dir(spark, "warc-test")
    runs = write_archives(capture_records(pages, F.lit("20200102030405")), folder)
    assert runs.select("file").distinct().count() > 6
    index = merge_index(runs)
    files = index.withColumn("part", F.input_file_name()).select("part", "url_key", "captured", "page_id").collect()
    order = [(r["url_key"], r["captured"], r["page_id"]) for r in sorted(files, key=lambda r: r["part"].rsplit("/", 1)[1])]
    # Rows of one part file are read in order.
    assert order == sorted(order)
    assert read_archives(index, folder).count() == pages.count()


@pytest.mark.parametrize("run_rows, fan_in", [(10**6, 64), (50, 64), (40, 3), (1, 2)])
def test_runs_merge_in_passes(run_rows, fan_in):
    random.seed(7)
    rows = [(random.choice("abc"), str(random.randint(0, 9)), random.choice([None, 1, 2, 3]), "r", "d", f"f{i}", i, 1) for i in range(700)]
    batches = [warc._batch(sorted(rows[i : i + 35], key=warc._key)) for i in range(0, 700, 35)]
    assert list(merged_runs(iter(batches), run_rows, fan_in)) == sorted(rows, key=warc._key)
    assert list(merged_runs(iter([]), run_rows, fan_in)) == []


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    random.seed(k)
    row = lambda n: (f"{n:04d}", "", 1, "", "", "", 0, 0)
    streams = [sorted(random.randint(0, 50) for _ in range(random.randint(0, 20))) for _ in range(k)]
    got = [int(r[0]) for r in LoserTree([iter([row(n) for n in s]) for s in streams])]
    assert got == sorted(n for s in streams for n in s)


def test_a_damaged_record_is_found():
    row = {"page_id": 1, "url": "u", "html": "abc", "sha1": hashlib.sha1(b"abc").hexdigest(), "bytes": 3,
           "captured": "20200102030405", "record_type": "response"}
    data = record_bytes(row)
    assert parsed_record(data)["payload"] == b"abc"
    with pytest.raises(ValueError):
        parsed_record(data.replace(b"abc", b"abd"))
    assert INDEX.names[-1] == "length"
