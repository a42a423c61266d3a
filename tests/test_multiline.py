"""The multi-line reader by blocks, against Spark's reader of whole files."""

import random

import pytest
from pyspark.sql import functions as F

from shelfmark.schemas import RAW
from shelfmark.sources.files import read_csv
from shelfmark.sources.multiline import _blocks, _lines, csv_records, read_multiline_csv

SCHEMA = RAW["product_metadata"]
HEADER = "id,brand,rating,stock,category,note"


def quoted(text, rng):
    if any(c in text for c in '",\r\n') or rng.random() < 0.2:
        return '"' + text.replace('"', '""') + '"'
    return text


def some_file(seed, rows, end):
    rng = random.Random(seed)
    pieces = ["a", "bc", " ", ",", '"', '""', "\n", "\r\n", "\n\n", '",\n"', "é", "\\", "x" * 30]
    out = [HEADER]
    for i in range(rows):
        note, brand = ("".join(rng.choices(pieces, k=rng.randint(0, 6))) for _ in range(2))
        cells = [str(i), brand.strip(" "), rng.choice(["1.5", "bad", ""]), rng.choice(["3", ""]), "c", note.strip(" ")]
        out.append(",".join(quoted(c, rng) for c in cells))
        if rng.random() < 0.1:
            out.append("")
    return end.join(out) + (end if rng.random() < 0.5 else "")


@pytest.fixture
def blocks(conf):
    return lambda size: conf(files__maxPartitionBytes=str(size), files__openCostInBytes="0")


def both(spark, path, rows):
    columns = [f.name for f in SCHEMA] + ["note"]
    ours, theirs = read_multiline_csv(spark, path, SCHEMA), read_csv(spark, path, SCHEMA, multiline=True)
    assert ours.dtypes == theirs.dtypes
    bad = F.col("_corrupt_record").isNotNull()
    return rows(ours, *columns, bad), rows(theirs, *columns, bad)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
def test_equals_the_reader_of_whole_files(spark, tmp_path, rows, blocks, end, size):
    for n in range(2 if size < 64 else 4):
        (tmp_path / f"{n}.csv").write_bytes(some_file(n, 12 if size < 64 else 40, end).encode())
    blocks(size)
    ours, theirs = both(spark, str(tmp_path), rows)
    assert ours == theirs and len(ours) > 20


def test_every_border_in_quotes_line_ends_and_empty_lines(spark, tmp_path, rows, blocks):
    text = f'{HEADER}\r\n1,"a""\r\n\n""b",,,,"x,\r\ny"\r\n\r\n2,"",1.5,3,,"""\n"""\r\n'
    (tmp_path / "one.csv").write_bytes(text.encode())
    want = [("1", 'a"\n\n"b', None, None, None, "x,\ny"), ("2", None, 1.5, 3, None, '"\n"')]
    for size in range(1, len(text) + 1, 3):
        blocks(size)
        got = read_multiline_csv(spark, str(tmp_path), SCHEMA)
        assert rows(got, "id", "brand", "rating", "stock", "category", "note") == want, size


def test_a_record_longer_than_many_blocks(spark, tmp_path, rows, blocks):
    long = "\n".join(f'line "{i}", end' for i in range(200))
    body = [f"{HEADER}", "1,a,,,,x", '2,b,,,,"' + long.replace('"', '""') + '"', "3,c,,,,z"]
    (tmp_path / "one.csv").write_text("\n".join(body))
    blocks(50)
    ours, theirs = both(spark, str(tmp_path), rows)
    assert ours == theirs and ours[1][-2] == long


def test_a_large_file_is_many_tasks(spark, tmp_path, blocks):
    cell = '"' + 'a ""b"",\n' * 30 + '"'
    (tmp_path / "one.csv").write_text("id,note\n" + "".join(f"{i},{cell}\n" for i in range(20_000)))
    blocks(200_000)
    path = str(tmp_path)
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    sizes = _lines(spark, path).groupBy("_block").count()
    assert sizes.count() > 20 and sizes.agg(F.max("count")).first()[0] < 60_000
    got = read_multiline_csv(spark, path, SCHEMA)
    assert got.count() == 20_000
    assert got.where(F.length("note") != 30 * 7).count() == 0
    plan = csv_records(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan


def test_blocks_know_whether_they_begin_inside_a_cell(spark, tmp_path, blocks):
    (tmp_path / "one.csv").write_text('a,b\n1,"\n\n\n\n\n\n\n\n"\n2,3\n')
    blocks(4)
    inside = [(r["_inside"], r["_goes_on"]) for r in _blocks(_lines(spark, str(tmp_path))).orderBy("_block").collect()]
    assert inside[0] == (0, False) and (1, True) in inside and inside[-1][1] is False
    assert all(a[1] == (b[0] == 1) for a, b in zip(inside, inside[1:]))


def test_stray_quotes_and_other_headers_are_errors(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,brand\n1,5" pipe\n2,6" pipe\n')
    with pytest.raises(Exception, match="a quote inside a cell that is not quoted"):
        read_multiline_csv(spark, str(tmp_path), SCHEMA).collect()
    (tmp_path / "a.csv").write_text("id,brand\n1,x\n")
    (tmp_path / "b.csv").write_text("brand,id\nx,1\n")
    with pytest.raises(Exception, match="another header"):
        read_multiline_csv(spark, str(tmp_path), SCHEMA).collect()


def test_a_header_alone_a_mark_and_no_line_end(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_bytes(b"id,brand\n")
    assert rows(read_multiline_csv(spark, str(tmp_path), SCHEMA)) == []
    (tmp_path / "a.csv").write_bytes(b"id,brand\n1,x")
    (tmp_path / "b.csv").write_bytes(b"")
    assert rows(read_multiline_csv(spark, str(tmp_path), SCHEMA), "id", "brand") == [("1", "x")]


def test_lines_are_neither_shuffled_nor_sorted(spark, tmp_path):
    (tmp_path / "one.csv").write_bytes(some_file(1, 40, "\n").encode())
    records = csv_records(spark, str(tmp_path))
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    # Lines by block, the blocks of a file and the cut records of a file: no window or group over the lines themselves.
    assert "Window [sum(_quotes" not in plan and "_line ASC" not in plan
    assert plan.count("MapInArrow") == 2


@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_records_longer_than_a_batch_of_lines(spark, tmp_path, rows, blocks, conf, batch):
    conf(execution__arrow__maxRecordsPerBatch=str(batch))
    for n in range(3):
        (tmp_path / f"{n}.csv").write_bytes(some_file(n, 30, "\n").encode())
    blocks(300)
    ours, theirs = both(spark, str(tmp_path), rows)
    assert ours == theirs and len(ours) > 20
