"""Which feeds may run, as told by the control sheet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheetmill.functions.text import parse_key_list
from sheetmill.model import ROW_ID, BadConfig, FeedConfig, FeedError
from sheetmill.operators.ingest import assemble, collect_headers, feed_shapes, require_data
from sheetmill.sources.sheets import read_sheets

#: Fixed value: the worksheet that lists the jobs.
CONTROL_SHEET = "pipeline_control"


def read_control(spark: SparkSession, sheets: str, multi_line: bool = True) -> DataFrame:
    """The exported control sheet, one row per job, in sheet order ``pos``."""
    rows = read_sheets(spark, sheets, multi_line).filter(F.col("feed") == CONTROL_SHEET)
    headers = collect_headers(rows)
    require_data([CONTROL_SHEET], headers)
    first = feed_shapes(rows)[CONTROL_SHEET].header
    return assemble(rows, headers[CONTROL_SHEET], first).withColumnRenamed(ROW_ID, "pos")


def first_entries(control: DataFrame, order: str = "pos") -> DataFrame:
    """``(job_name, status, ok)`` of the first control row of each job."""
    status = F.upper(F.coalesce(F.min_by("status", order), F.lit("")))
    return (
        control.groupBy("job_name")
        .agg(status.alias("status"))
        .withColumn("ok", F.col("status") == "OK")
    )


def gate_feeds(rows: DataFrame, control: DataFrame, order: str = "pos") -> DataFrame:
    """Rows of feeds whose job has status OK, in any letter case.

    No broadcast is forced: the measured size of the control side decides.
    """
    allowed = first_entries(control, order).filter("ok").select(F.col("job_name").alias("feed"))
    return rows.join(allowed, "feed", "left_semi")


def blocked_feeds(rows: DataFrame, control: DataFrame, order: str = "pos") -> DataFrame:
    """``(feed, status)`` of feeds that may not run; status is NULL for an unknown job."""
    entries = first_entries(control, order)
    feeds = rows.select("feed").distinct()
    return (
        feeds.join(entries, feeds["feed"] == entries["job_name"], "left")
        .filter("ok is null or not ok")
        .select("feed", "status")
    )


def approved_configs(
    control: DataFrame, jobs: Sequence[str] | None = None, order: str = "pos"
) -> list[FeedConfig | BadConfig]:
    """Configurations of the jobs with status OK; an unusable row becomes a ``BadConfig``.

    Naming a job that is unknown or not OK is an error; without names every OK job is taken.
    The result is driver metadata, one value per configured job.
    """
    fields = [c for c in control.columns if c not in ("job_name", order)]
    entries = control.groupBy("job_name").agg(F.min_by(F.struct(*fields), order).alias("entry"))
    if jobs is not None:
        entries = entries.filter(F.col("job_name").isin(list(jobs)))
    found = {
        r.job_name: r
        for r in entries.select(
            "job_name", "entry.*", parse_key_list(F.col("entry.primary_keys")).alias("keys")
        ).collect()
    }
    for job in jobs or ():
        if job not in found:
            raise FeedError(f"job {job!r} is not in the control sheet")
        status = (found[job].status or "").upper()
        if status != "OK":
            raise FeedError(f"job {job!r} has status {status!r}; only OK jobs may run")
    configs: list[FeedConfig | BadConfig] = []
    for job, r in sorted(found.items()):
        if (r.status or "").upper() == "OK":
            try:
                row = {**r.asDict(), "primary_keys": r["keys"] or ()}
                configs.append(FeedConfig.from_control_row(row))
            except Exception as error:  # one row must not stop the others
                configs.append(BadConfig(job, error))
    return configs
