"""What each run has done: one record per batch of feeds and finished layer.

Records of a run lie in a folder of their own, so a repeated run reads its own ones only. The columns that runs
found are read back as a table.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from typing import Any
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheetmill.model import RunContext
from sheetmill.operators.history import HISTORY
from sheetmill.session import files_of
from sheetmill.sources.records import next_name, put_record, read_records

_COLUMN = "struct<col: string, pos: int, grp: string>"
_RECORD = (
    "layer string, batch string, job_date date, job_id string, load_datetime timestamp_ntz, "
    f"feeds array<struct<job: string>>, columns array<{_COLUMN}>"
)


@dataclass(frozen=True)
class Ledger:
    """The records below ``folder``."""

    spark: SparkSession
    folder: str

    def _run(self, ctx: RunContext) -> str:
        return f"{self.folder}/{ctx.job_date:%Y%m%d}/run-{quote(ctx.job_id, safe='')}"

    def add(self, ctx: RunContext, batch: str, layer: str, value: dict[str, Any]) -> None:
        run = {
            "job_date": ctx.job_date.isoformat(),
            "job_id": ctx.job_id,
            "load_datetime": ctx.load_datetime.isoformat(),
        }
        folder = self._run(ctx)
        name = next_name(self.spark, folder, f"{batch}-{layer}")
        put_record(self.spark, folder, name, {"batch": batch, "layer": layer, **run, **value})

    def batches(self, ctx: RunContext) -> dict[str, dict[str, dict[str, Any]]]:
        """Records of a run by batch and layer, in the order in which the batches began."""
        found: dict[str, dict[str, dict[str, Any]]] = {}
        for _, value in read_records(self.spark, self._run(ctx)):
            found.setdefault(value["batch"], {})[value["layer"]] = value
        return found

    def schemas(self) -> DataFrame:
        """Columns of every feed and run: feed, job_date, job_id, load_datetime, pos, col, grp. The newest load of a
        feed in a run counts."""
        files, location = files_of(self.spark, self.folder)
        if not files.exists(location):
            return self.spark.createDataFrame([], HISTORY)
        records = self.spark.read.schema(_RECORD).option("recursiveFileLookup", True).json(self.folder)
        loads = (
            records.where(F.col("layer") == "tmp")
            .select("*", F.explode("feeds.job").alias("feed"), F.col("_metadata.file_name").alias("name"))
            .groupBy("feed", "job_date", "job_id")
            .agg(F.max_by(F.struct("load_datetime", "columns"), "name").alias("last"))
        )
        columns = loads.select(
            "feed", "job_date", "job_id", "last.load_datetime", F.inline("last.columns").alias("col", "pos", "grp")
        )
        return columns.select(*HISTORY.names)


def ledger_time(record: dict[str, Any]) -> datetime:
    return datetime.fromisoformat(record["load_datetime"])
