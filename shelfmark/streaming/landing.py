"""Land raw files once each: re-runs pick up only the files that are new."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from shelfmark.operators.quality import rows_metric
from shelfmark.sources.files import (
    CORRUPT,
    CSV_OPTIONS,
    DELIVERED,
    LOAD,
    SOURCE_FILE,
    bad_record_count,
    csv_schema,
)

log = logging.getLogger(__name__)

_METRICS = "landed"
_ASKED_EVERY = 0.5


def by_modification_time() -> Column:
    """Deliveries in the order in which their files were last written."""
    return F.col("_metadata.file_modification_time")


def by_file_name() -> Column:
    """Deliveries in the order of their files' names, for names that begin with a date or number.

    Holds where files are copied or restored, which gives them new times.
    """
    return F.col("_metadata.file_name")


def _counts(query: StreamingQuery) -> dict[int, Mapping[str, int]]:
    """The counts of every batch of a query, once it has ended.

    Spark keeps those of the last hundred batches. They are asked for while the
    query runs, far more often than a hundred batches can end.
    """
    counts = {}
    ended = False
    while not ended:
        ended = query.awaitTermination(_ASKED_EVERY)
        for progress in query.recentProgress:
            if (batch := progress.observedMetrics.get(_METRICS)) is not None:
                counts[progress.batchId] = batch
    if counts and len(counts) <= max(counts) - min(counts):
        log.warning("counts of some batches were missed: the rows are landed, but fewer are reported")
    return counts


def land_csv(
    spark: SparkSession,
    path: str,
    target: str,
    checkpoint: str,
    schema: StructType,
    multiline: bool = False,
    files_per_batch: int = 10_000,
    delivered: Column | None = None,
    load_number: int | None = None,
) -> Mapping[str, int]:
    """Append the CSV files below ``path`` that were not landed yet to a Parquet table.

    The stream's checkpoint records which files are done and the Parquet sink's
    own log which output files count, so a run that is cut off and repeated
    lands each file exactly once. Files count as the same by path: a delivery
    must not reuse a name. Each row notes its file and ``delivered``, which
    orders the deliveries, by default the file's modification time; files that
    tie are ordered by path. A missing input path is an error. With a
    ``load_number`` the rows go to a partition of that number, so that readers can
    tell them from those of other loads.

    Returns ``row_count`` and ``bad_records`` of the files landed by this run, as
    the tasks counted them while writing, over all its batches.
    """
    in_order = csv_schema(spark, path, schema, multiline)
    files = (
        spark.readStream.options(**CSV_OPTIONS, multiLine=multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .schema(StructType([*in_order, StructField(CORRUPT, StringType())]))
        .csv(path)
    )
    landed = files.select(
        "*",
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        (by_modification_time() if delivered is None else delivered).alias(DELIVERED),
        *([] if load_number is None else [F.lit(load_number).cast("long").alias(LOAD)]),
    ).observe(_METRICS, rows_metric(), bad_record_count())
    writer = (
        landed.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if load_number is not None:
        writer = writer.partitionBy(LOAD)
    counted = _counts(writer.start()).values()
    return {
        name: sum(batch[name] or 0 for batch in counted) for name in ("row_count", "bad_records")
    }
