"""A journal of the steps of a run, so that a run that was cut off goes on where it stopped.

A step is entered when its output is whole, with a fingerprint of what it read.
A run of the same name skips steps that are entered with the fingerprint that
their input still has; a step that was cut off has no entry and is repeated,
and so is every step whose input has changed since, such as one that reads the
output of a repeated step. Steps overwrite or publish what they write, so a
repeated one leaves no traces of the one before.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, is_dataclass
from threading import Lock
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.schemas import JOURNAL

log = logging.getLogger(__name__)


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """One value for all files below the paths: their paths, lengths and times, in no order.

    Lists the files and reads none; ``paths`` must exist. One row comes to the driver.
    """
    if not paths:
        return ""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(list(paths))
        .select("path", "length", "modificationTime")
    )
    each = F.xxhash64("path", "length", "modificationTime")
    seen = files.agg(F.count("*"), F.bit_xor(each), F.sum(F.pmod(each, F.lit(1 << 31)))).first()
    return ":".join(str(v) for v in seen)


class NoJournal:
    """Every step is taken."""

    def once(
        self, step: str, action: Callable[[], Mapping[str, Any] | None], reads: Sequence[str] = (), state: str = ""
    ) -> Mapping[str, Any]:
        return action() or {}


class Journal:
    """The steps of one named run. Steps may be taken by several threads."""

    def __init__(self, spark: SparkSession, path: str, run: str):
        self.spark, self.path, self.run = spark, path, run
        self._writing = Lock()
        self._done = {r.step: (r.fingerprint, r.metrics) for r in self.entries().orderBy("number").collect()}
        self._number = self.entries().agg(F.max("number")).first()[0] or 0

    def entries(self) -> DataFrame:
        """run, number, step, fingerprint, metrics of this run, a row per finished step."""
        self.spark.createDataFrame([], JOURNAL).write.mode("ignore").parquet(self.path)
        return self.spark.read.schema(JOURNAL).parquet(self.path).where(F.col("run") == self.run)

    def once(
        self, step: str, action: Callable[[], Mapping[str, Any] | None], reads: Sequence[str] = (), state: str = ""
    ) -> Mapping[str, Any]:
        """Take the step, unless it was taken with the inputs of now; returns its metrics.

        ``reads`` are the paths that the step reads; ``state`` stands for inputs that are not
        files. A step with neither is taken once in a run of this name. Of a step that is
        skipped the metrics are those noted, as JSON gives them back.
        """
        inputs = f"{state}/{fingerprint(self.spark, reads)}"
        done = self._done.get(step)
        if done is not None and done[0] == inputs:
            log.info("%s: %s was done before", self.run, step)
            return json.loads(done[1])
        metrics = action() or {}
        noted = asdict(metrics) if is_dataclass(metrics) else dict(metrics)
        self._enter(step, inputs, json.dumps(noted, default=str))
        return metrics

    def _enter(self, step: str, inputs: str, metrics: str) -> None:
        # One file per entry, which appears at once or not at all; one writer at a time.
        with self._writing:
            self._number += 1
            row = (self.run, self._number, step, inputs, metrics)
            self.spark.createDataFrame([row], JOURNAL).coalesce(1).write.mode("append").parquet(self.path)
            self._done[step] = (inputs, metrics)
