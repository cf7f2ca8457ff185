"""Markers and summaries of a run, kept as tables."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from costflow.sqltext import one_row

MARKER_SCHEMA = (
    "run_id string, seq int, step string, message string, "
    "row_count bigint, column_count int, marked_at timestamp"
)
SUMMARY_SCHEMA = (
    "run_id string, job string, table string, input_path string, raw_count bigint, "
    "output_count bigint, columns_out int, timings map<string,double>, finished_at timestamp"
)


class RunLog:
    """Appends to `<path>/markers/<run id>` (Parquet) and `<path>/summaries` (JSON).

    Rows carry the run id, so an old run's markers cannot pass for a new one's.
    """

    def __init__(self, spark: SparkSession, path: str, run_id: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.run_id = run_id or uuid.uuid4().hex
        self.timings: dict[str, float] = {}
        self._seq = 0
        self._watched: list[tuple[str, Observation, int]] = []
        self._started = time.monotonic()

    def mark(
        self,
        step: str,
        message: str = "",
        row_count: int | None = None,
        column_count: int | None = None,
    ) -> None:
        marker = one_row(
            self.spark,
            run_id=("string", self.run_id),
            seq=("int", self._seq),
            step=("string", step),
            message=("string", message),
            row_count=("bigint", row_count),
            column_count=("int", column_count),
            marked_at=("timestamp", _now()),
        )
        self._seq += 1
        marker.write.mode("append").parquet(f"{self.path}/markers/{self.run_id}")

    def watched(self, step: str, df: DataFrame) -> DataFrame:
        """`df`, its rows to be counted when it runs as part of a later write; see `mark_watched`."""
        seen = Observation()
        self._watched.append((step, seen, len(df.columns)))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def mark_watched(self) -> dict[str, int]:
        """A marker for each watched stage, from the one pass that ran them all.

        Rows that a lost executor made Spark repeat are counted again; compare the
        last stage with the footers of what was written.
        """
        counts = {step: (seen.get["rows"], width) for step, seen, width in self._watched}
        self._watched.clear()
        for step, (rows, width) in counts.items():
            self.mark(step, row_count=rows, column_count=width)
        return {step: rows for step, (rows, _) in counts.items()}

    @contextmanager
    def timed(self, stage: str) -> Iterator[None]:
        start = time.monotonic()
        try:
            yield
        finally:
            self.timings[f"{stage}_sec"] = round(time.monotonic() - start, 2)

    def summarize(
        self, job: str, table: str, input_path: str, raw_count: int | None, output_count: int, columns_out: int
    ) -> Mapping[str, float]:
        timings = self.timings | {"total_sec": round(time.monotonic() - self._started, 2)}
        summary = one_row(
            self.spark,
            run_id=("string", self.run_id),
            job=("string", job),
            table=("string", table),
            input_path=("string", input_path),
            raw_count=("bigint", raw_count),
            output_count=("bigint", output_count),
            columns_out=("int", columns_out),
            timings=("string", json.dumps(timings)),
            finished_at=("timestamp", _now()),
        ).withColumn("timings", F.from_json("timings", "map<string,double>"))
        summary.write.mode("append").json(f"{self.path}/summaries")
        return timings

    def markers(self, all_runs: bool = False) -> DataFrame:
        found = self.spark.read.schema(MARKER_SCHEMA).option("recursiveFileLookup", "true")
        log = found.parquet(f"{self.path}/markers")
        return log if all_runs else log.where(F.col("run_id") == self.run_id)

    def summaries(self, all_runs: bool = False) -> DataFrame:
        log = self.spark.read.schema(SUMMARY_SCHEMA).json(f"{self.path}/summaries")
        return log if all_runs else log.where(F.col("run_id") == self.run_id)


def _now() -> datetime:
    return datetime.now(timezone.utc)
