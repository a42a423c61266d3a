import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from shelfmark.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copies int, size string, fingerprint string"
LONG = " ".join(f"word{i} the of and" for i in range(4000))
ODD = [
    (i, f"the of and that with number {i} in the text of {i * 7}", "en", "a" if i % 3 else "hot", 1, 1, "s", "f") for i in range(60)
] + [
    (100, None, None, None, None, None, None, None), (101, "", "en", "a", 0, 1, "s", "f"), (None, "the of no id", "en", None, 1, 1, "s", "f"),
    (103, "123 456", "en", "b", 1, 1, "s", "f"), (104, LONG, "en", "b", 1, 1, "s", "f"),
    (5, "the of a repeated row here", "en", "a", 1, 1, "s", "f"), (5, "the of a repeated row here", "en", "a", 1, 1, "s", "f"),
    (105, "THE OF a repeated row here", "en", "a", 1, 1, "s", "f"),
]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "none"])
def test_stages_take_odd_rows(spark, sf_dir, name, stage, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = stage(spark, docs, sf_dir)
    got = out.collect()
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == docs.columns
        assert out.dtypes == docs.dtypes
        assert {tuple(r) for r in got} <= set(rows)
    if not rows:
        assert not got
    ids = [r["doc_id"] for r in got]
    if name == "language_id" and rows:
        assert not {100, 101, 103} & set(ids) and ids.count(5) == 3 and 104 in ids and None in ids
    if name == "exact_dedup":
        assert ids.count(105) == 1 * bool(rows) and ids.count(5) == 1 * bool(rows)
    if name == "simhash_near_dedup" and rows:
        assert 105 not in ids
        assert [r["doc_id"] for r in got if r["text"] == "the of a repeated row here"] == [5]


def test_run_ends_in_lossless_tokens_of_a_mix(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    rows = out.collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert rows and all(r["lossless"] for r in rows)
    assert {r["doc_id"] for r in rows} <= set(texts)
    copies = [r["doc_id"] for r in rows]
    assert max(copies.count(i) for i in set(copies)) <= 2
    kept = {texts[i].encode().lower() for i in set(copies)}
    assert len(kept) == len(set(copies))


def test_every_query_is_registered():
    names = __spark_entry__.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    with duckdb.connect() as con:
        for table in ("documents", "conversations", "embeddings"):
            con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
        cursor = con.execute(ORACLES[name])
        columns = [d[0] for d in cursor.description]
        wanted = cursor.fetchall()
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, wanted))
