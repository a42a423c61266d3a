"""CSV and Parquet readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Columns the readers add: an unreadable line, and where, when and by which load a row came in.
CORRUPT = "_corrupt_record"
SOURCE_FILE = "_source_file"
DELIVERED = "_delivered_at"
LOAD = "_load"

# Quotes inside a quoted cell are doubled, and a backslash is just a character.
CSV_OPTIONS = {"header": True, "escape": '"', "enforceSchema": False}


def csv_schema(
    spark: SparkSession, path: str, schema: StructType, multiline: bool = False
) -> StructType:
    """``schema`` in the order of the file's header; unknown columns are text.

    Looks at the header line only. There is no inference pass over the data, and
    a column's type cannot drift with its content.
    """
    header = spark.read.options(**CSV_OPTIONS, multiLine=multiline).csv(path).columns
    known = {f.name: f.dataType for f in schema}
    return StructType([StructField(name, known.get(name, StringType())) for name in header])


def read_csv(
    spark: SparkSession, path: str, schema: StructType, multiline: bool = False
) -> DataFrame:
    """CSV with a header, matched by column name.

    A cell that does not fit its type becomes NULL and the whole line is kept in
    ``_corrupt_record``. Columns of ``schema`` the file lacks are left out.
    Multi-line files cannot be split, so large extracts should come as many files.
    """
    in_order = csv_schema(spark, path, schema, multiline)
    return (
        spark.read.options(**CSV_OPTIONS, multiLine=multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(StructType([*in_order, StructField(CORRUPT, StringType())]))
        .csv(path)
    )


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, all cells as text, and the file each row is from; one pass over it, no inference."""
    rows = spark.read.options(**CSV_OPTIONS).csv(path)
    return rows.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def inferred_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """CSV with types inferred from the data, for drift checks: one extra pass over the file."""
    return spark.read.options(**CSV_OPTIONS, multiLine=multiline, inferSchema=True).csv(path)


def data_columns(df: DataFrame) -> DataFrame:
    """Without the columns the readers add, but for the delivery time."""
    return df.drop(CORRUPT, SOURCE_FILE)


def bad_record_count() -> Column:
    """Aggregate expression: lines with a cell that did not fit its type."""
    return F.count_if(F.col(CORRUPT).isNotNull()).alias("bad_records")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet directory; partition directories become columns."""
    return spark.read.parquet(path)
