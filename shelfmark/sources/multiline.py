"""CSV with line feeds inside quoted cells, read by many tasks.

Spark's own multi-line reader takes a file as a whole. Here a file is read as
lines, which can be done from any place in it, and records are put together
again: a quoted cell is open wherever the number of quotes before is odd. The
quotes of every block (a part of a file that one task reads) are counted first;
sums over the blocks before say whether a block begins inside a cell. Then a
record begins with every line that is not inside a cell. Tasks read the lines of
a block in their order and put its records together as they come, so that no
line is shuffled or sorted; only the records that a block border cuts, two pieces
of every block at most, are put together across blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfmark.sources.files import CORRUPT, CSV_OPTIONS, csv_schema

_BLOCK = ["_file", "_block"]
# A record of quoted cells, in which quotes are doubled, and of cells without quotes.
_CELL = '(?:"(?:[^"]++|"")*+"|[^",\\n]*+)'
WELL_QUOTED = f"^{_CELL}(?:,{_CELL})*+$"
_PARSE = {
    "escape": CSV_OPTIONS["escape"], "multiLine": "true", "lineSep": "\n", "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file, the place where its block starts, and its order within the block."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("value").alias("_value"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("_quotes"),
    )


def _blocks(lines: DataFrame) -> DataFrame:
    """Of every block: whether it begins, and whether it ends, inside a cell; whether lines end in CRLF.

    As with Spark's reader the first line of a file tells how its lines end.
    """
    counted = lines.groupBy(*_BLOCK).agg(
        (F.sum("_quotes") % 2).alias("_odd"), F.min_by(F.col("_value").endswith("\r"), "_line").alias("_cr")
    )
    before = Window.partitionBy("_file").orderBy("_block")
    upto = F.sum("_odd").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return counted.select(
        *_BLOCK,
        ((upto - F.col("_odd")) % 2).alias("_inside"),
        (upto % 2 == 1).alias("_goes_on"),
        F.first("_cr").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_crlf"),
    )


def _joined(parts: str, *order: str) -> Column:
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(parts).alias("_part"))))
    return F.array_join(F.transform(rows, lambda r: r["_part"]), "\n")


_PIECE = "_text string, _file string, _block long, _number long, _crlf boolean"


def _assembled(cut: bool):
    """From lines in the order of their blocks: the whole records, or the pieces of those that block borders cut.

    Lines before the first beginning in a block have number 0: they go on with a
    record of a block before. Texts are joined in Arrow; only the record that a
    batch of lines leaves open is held.
    """

    def pieces(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        schema = pa.schema(
            [("_text", pa.string()), ("_file", pa.string()), ("_block", pa.int64()), ("_number", pa.int64()), ("_crlf", pa.bool_())]
        )
        # The block, whether it ends inside a cell, the quotes so far, the beginnings so far, the open record's texts.
        block, goes_on, quotes, number, parts = None, False, 0, 0, []

        def piece(texts, first):
            n = len(texts)
            file, start, crlf = (pa.repeat(pa.scalar(v, schema.field(c).type), n) for c, v in zip(("_file", "_block", "_crlf"), block))
            return pa.RecordBatch.from_arrays([texts, file, start, pa.array(np.arange(first, first + n)), crlf], schema=schema)

        def ended(last):
            """The open record, if it is one to be given."""
            if parts and (number == 0 or (last and goes_on)) == cut:
                yield piece(pa.array(["\n".join(parts)], pa.string()), number)

        for batch in batches:
            texts = batch.column("_value")
            counts = batch.column("_quotes").to_numpy()
            files, starts = batch.column("_file"), batch.column("_block")
            new = np.zeros(len(batch), bool)
            if len(batch):
                at = np.arange(1, len(batch))
                new[at] = pc.or_(
                    pc.not_equal(files.slice(1), files.slice(0, len(at))), pc.not_equal(starts.slice(1), starts.slice(0, len(at)))
                ).to_numpy(zero_copy_only=False)
                new[0] = block is None or (files[0].as_py(), starts[0].as_py()) != block[:2]
            bounds = [*np.unique([0, *np.flatnonzero(new)]).tolist(), len(batch)]
            for low, high in zip(bounds, bounds[1:]):
                if new[low]:
                    yield from ended(True)
                    block = (files[low].as_py(), starts[low].as_py(), batch.column("_crlf")[low].as_py())
                    goes_on = batch.column("_goes_on")[low].as_py()
                    quotes, number, parts = batch.column("_inside")[low].as_py(), 0, []
                upto = quotes + np.cumsum(counts[low:high])
                begins = low + np.flatnonzero((upto - counts[low:high]) % 2 == 0)
                quotes = int(upto[-1])
                end = int(begins[0]) if len(begins) else high
                parts += texts.slice(low, end - low).to_pylist()
                if not len(begins):
                    continue
                yield from ended(False)
                if len(begins) > 1 and not cut:
                    lists = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), texts)
                    yield piece(pc.binary_join(lists, "\n"), number + 1)
                number += len(begins)
                parts = texts.slice(int(begins[-1]), high - int(begins[-1])).to_pylist()
        yield from ended(True)

    return pieces


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per record, as text, with ``_is_header`` for the first of each file; empty lines are left out.

    What is known of the blocks, a row for each, goes to every task.
    """
    lines = _lines(spark, path)
    placed = lines.join(F.broadcast(_blocks(lines)), _BLOCK).select(
        "_value", *_BLOCK, F.col("_quotes").cast("long"), F.col("_inside").cast("long"), "_goes_on", "_crlf"
    )
    first = (F.col("_block") == 0) & (F.col("_number") == 1)
    whole = placed.mapInArrow(_assembled(cut=False), _PIECE).select("_text", "_crlf", first.alias("_is_header"))
    # Of every block two pieces at most: the end of one record and the beginning of another.
    in_file = Window.partitionBy("_file").orderBy("_block", "_number")
    record = F.sum((F.col("_number") > 0).cast("long")).over(in_file)
    mended = (
        placed.mapInArrow(_assembled(cut=True), _PIECE)
        .withColumn("_first", first)
        .withColumn("_record", record)
        .groupBy("_file", "_record")
        .agg(
            _joined("_text", "_block", "_number").alias("_text"),
            F.first("_crlf").alias("_crlf"),
            F.bool_or("_first").alias("_is_header"),
        )
        .select("_text", "_crlf", "_is_header")
    )
    # Where lines end in CRLF, Spark's reader gives LF also inside cells.
    ended = F.regexp_replace(F.replace("_text", F.lit("\r\n"), F.lit("\n")), "\r$", "")
    text = F.when(F.col("_crlf"), ended).otherwise(F.col("_text"))
    return whole.unionByName(mended).select(text.alias("_text"), "_is_header").where(F.col("_text") != "")


def read_multiline_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What ``read_csv`` with ``multiline`` reads, by as many tasks as the files have blocks.

    Files are UTF-8, with LF or CRLF, and quote as RFC 4180 says: a cell is quoted
    as a whole, with quotes doubled, or has none. Otherwise records can't be told
    apart by counting quotes: such a record is an error, and so is a file with
    another header than the first; ``read_csv`` reads files with stray quotes.
    """
    in_order = csv_schema(spark, path, schema, multiline=True)
    names = [f.name for f in in_order]
    fields = [*in_order, StructField(CORRUPT, StringType())]
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)
    texts = ", ".join(f"c{i} string" for i in range(len(names)))
    text = F.col("_text")
    header = F.from_csv(F.regexp_replace(text, "^\ufeff", ""), texts, {k: v for k, v in _PARSE.items() if k != "columnNameOfCorruptRecord"})
    same = F.forall(
        F.arrays_zip(F.array(*[header[f"c{i}"] for i in range(len(names))]).alias("a"), F.array(*map(F.lit, names)).alias("b")),
        lambda pair: pair["a"].eqNullSafe(pair["b"]),
    )

    def error(what: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{path}: {what}: "), F.substring(text, 1, 200))).cast("boolean")

    data = (
        F.when(~text.rlike(WELL_QUOTED), error("a quote inside a cell that is not quoted"))
        .when(F.col("_is_header") & ~same, error("another header"))
        .otherwise(~F.col("_is_header"))
    )
    parsed = F.from_csv(text, ddl, _PARSE)
    return csv_records(spark, path).where(data).select(parsed.alias("_row")).select("_row.*")
