"""Warehouse tables addressed as ``dataset.table``.

The rows of a table are written to a new folder each time and become the table by one step: a pointer record in a
folder of records, or in a catalog a view that is replaced. So a write that fails, wherever it does, leaves the table as
it was, and a reader never meets a missing or half-written table. Rejects are attempts, each in
folders of its own, and a log of records that says which of them count.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from sheetmill.model import REJECT_SCHEMA, FeedError, RunContext
from sheetmill.session import files_of
from sheetmill.sources.records import (
    delete_record,
    next_name,
    put_record,
    read_record,
    read_records,
    record_names,
)

#: A run as it is named in the reject log.
Run = tuple[str, str]


def run_key(ctx: RunContext) -> Run:
    return ctx.job_date.isoformat(), ctx.job_id


@dataclass(frozen=True)
class Warehouse:
    """Parquet tables below ``base``, or catalog tables (views of their newest version) when no base is given.

    Of a replaced table the ``keep`` versions before the newest stay, for readers that began before the switch.
    """

    spark: SparkSession
    base: str | None = None
    keep: int = 1

    def _split(self, table: str) -> tuple[str, str]:
        dataset, _, name = table.partition(".")
        if not dataset or not name or "." in name:
            raise FeedError(f"expected dataset.table, got {table!r}")
        return dataset, name

    def _create_dataset(self, dataset: str) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{dataset}`")

    @property
    def store(self) -> str:
        """The folder of what belongs to no single table."""
        return self.base or self.spark.conf.get("spark.sql.warehouse.dir").rstrip("/")

    def path(self, table: str) -> str:
        """The folder of a table's versions and records."""
        dataset, name = self._split(table)
        if self.base:
            return f"{self.base}/{dataset}/{name}"
        self._create_dataset(dataset)
        return f"{self.spark.catalog.getDatabase(dataset).locationUri}/{name}__versions"

    def fresh(self, table: str) -> str:
        """A folder for a new version."""
        return f"{self.path(table)}/data/{uuid.uuid4().hex}"

    # Replaced tables

    def _pointers(self, table: str) -> str:
        return f"{self.path(table)}/pointers"

    def _current(self, table: str) -> dict | None:
        folder = self._pointers(table)
        while names := record_names(self.spark, folder):
            record = read_record(self.spark, folder, names[-1])
            if record is not None:
                return record
        return None

    def location(self, table: str) -> str | None:
        """The folder that holds the table's rows now."""
        record = self._current(table)
        return record and record["location"]

    def read(self, table: str) -> DataFrame:
        if not self.base:
            return self.spark.read.table(table)
        record = self._current(table)
        if record is None:
            raise FeedError(f"there is no table {table}")
        return self.spark.read.schema(T.StructType.fromJson(record["schema"])).parquet(record["location"])

    def replace(self, df: DataFrame, table: str) -> DataFrame:
        """Replace the table, columns included, and read it back."""
        location = self.fresh(table)
        try:
            df.write.parquet(location)
            self.publish(table, location, df.schema)
        except BaseException:
            if self.location(table) != location:
                self._delete(location)
            raise
        return self.read(table)

    def publish(self, table: str, location: str, schema: T.StructType) -> None:
        """Make the rows in ``location`` the table; older versions are deleted afterwards."""
        folder, version = self._pointers(table), uuid.uuid4().hex
        record = {"location": location, "schema": schema.jsonValue(), "version": version}
        name = next_name(self.spark, folder, version)
        if self.base:
            put_record(self.spark, folder, name, record)
        else:
            dataset, plain = self._split(table)
            rows = f"`{dataset}`.`{plain}__{version}`"
            self.spark.catalog.createTable(rows, path=location, source="parquet", schema=schema)
            put_record(self.spark, folder, name, record)
            self._show(table, f"SELECT * FROM {rows}")
        self._forget(table)

    def _show(self, table: str, query: str) -> None:
        """Let the catalog name stand for ``query``, in one step."""
        dataset, name = self._split(table)
        here = f"`{dataset}`.`{name}`"
        if self.spark.catalog.tableExists(here) and self.spark.catalog.getTable(here).tableType != "VIEW":
            raise FeedError(f"{table} is a table of its own; loads keep versions behind a view")
        self.spark.sql(f"CREATE OR REPLACE VIEW {here} AS {query}")

    def _forget(self, table: str) -> None:
        """Delete versions before the newest ``keep`` + 1. What cannot be deleted now goes the next time."""
        folder = self._pointers(table)
        try:
            found = read_records(self.spark, folder)
            kept = {value["location"] for _, value in found[-1 - self.keep :]}
            dataset, plain = self._split(table)
            for name, value in found[: -1 - self.keep]:
                if not self.base:
                    self.spark.sql(f"DROP TABLE IF EXISTS `{dataset}`.`{plain}__{value['version']}`")
                if value["location"] not in kept:
                    self._delete(value["location"])
                delete_record(self.spark, folder, name)
        except Exception as error:  # the new version is in place
            warnings.warn(f"old versions of {table} could not be deleted: {error}", stacklevel=2)

    def _delete(self, location: str) -> None:
        """Delete a folder, and those above it that this leaves empty (a batch of several tables)."""
        files, target = files_of(self.spark, location)
        files.delete(target, True)
        for _ in range(3):
            target = target.getParent()
            if target is None or not files.exists(target) or len(files.listStatus(target)):
                return
            files.delete(target, False)

    # Rejects

    def _log(self, table: str) -> str:
        return f"{self.path(table)}/log"

    def append_rejects(
        self, df: DataFrame, table: str, replace_run: RunContext | None = None
    ) -> DataFrame:
        """Add reject rows.

        They count from the moment that their record is in the log: an attempt that fails leaves nothing to be read, and
        appends from several processes do not meet. Rejects are few next to the rows they were filtered from, so they are
        rebalanced into reasonably sized files. With ``replace_run`` all rejects of that run that are in the log
        give way, even to nothing, so ``df`` must hold all its rejects and a retry does not add them twice.
        """
        location, seen = self.fresh(table), Observation()
        rows = df.select(*REJECT_SCHEMA.names).hint("rebalance")
        runs = F.collect_set(F.struct(F.col("job_date").cast("string"), "job_id")).alias("runs")
        try:
            rows.observe(seen, runs).write.parquet(location)
            held = sorted(map(tuple, seen.get["runs"]), key=repr)
            self.commit_rejects(table, [location], held, replace_run)
        except BaseException:
            if not any(location in value["locations"] for _, value in read_records(self.spark, self._log(table))):
                self._delete(location)
            raise
        return self.read_rejects(table)

    def commit_rejects(
        self, table: str, locations: Sequence[str], runs: Sequence[Run], replace_run: RunContext | None = None
    ) -> None:
        """Let the rejects of ``runs`` in these folders count; folders that do so already are not added again."""
        attempt, log = uuid.uuid4().hex, self._log(table)
        if self.holds_rejects(table, locations):
            return
        record = {
            "locations": list(locations),
            "runs": [list(r) for r in runs],
            "replaces": list(run_key(replace_run)) if replace_run else None,
        }
        if not self.base:
            self._register(table, attempt, locations)
        put_record(self.spark, log, next_name(self.spark, log, attempt), record)
        if not self.base:
            # Another process may commit between reading the log and replacing the view; then it is read again.
            names: list[str] = []
            while names != record_names(self.spark, log):
                names = record_names(self.spark, log)
                self._show_rejects(table)

    def holds_rejects(self, table: str, locations: Sequence[str]) -> bool:
        return any(value["locations"] == list(locations) for _, value in read_records(self.spark, self._log(table)))

    def _attempts(self, table: str) -> list[tuple[str, list[str], set[Run], set[Run]]]:
        """Name, folders, runs and hidden runs of every attempt that has anything to be read."""
        found, replaced = [], set()
        for name, value in reversed(read_records(self.spark, self._log(table))):
            runs = {tuple(r) for r in value["runs"]}
            if value["locations"] and not (runs and runs <= replaced):
                found.append((name, value["locations"], runs, runs & replaced))
            if value["replaces"]:
                replaced.add(tuple(value["replaces"]))
        return found[::-1]

    def read_rejects(self, table: str, run: RunContext | None = None) -> DataFrame:
        """Committed rejects, of all runs or of one; folders that hold none of it are not read."""
        whole, parts = [], []
        wanted = run_key(run) if run else None
        for _, locations, runs, hidden in self._attempts(table):
            if wanted and (wanted not in runs or wanted in hidden):
                continue
            (parts.append((locations, hidden)) if hidden else whole.extend(locations))
        reader = self.spark.read.schema(REJECT_SCHEMA)
        rows = reader.parquet(*whole) if whole else self.spark.createDataFrame([], REJECT_SCHEMA)
        for locations, hidden in parts:
            rows = rows.unionByName(reader.parquet(*locations).where(~_of_runs(hidden)))
        return rows.where(_of_runs({wanted})) if wanted else rows

    def _register(self, table: str, attempt: str, locations: Sequence[str]) -> None:
        dataset, plain = self._split(table)
        rows = f"`{dataset}`.`{plain}__attempts`"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in REJECT_SCHEMA)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {rows} ({columns}, _attempt STRING) USING parquet "
            f"PARTITIONED BY (_attempt) LOCATION '{self.path(table)}/rows'"
        )
        for k, location in enumerate(locations):
            self.spark.sql(f"ALTER TABLE {rows} ADD PARTITION (_attempt = '{attempt}-{k}') LOCATION '{location}'")

    def _show_rejects(self, table: str) -> None:
        dataset, plain = self._split(table)

        def text(value: str) -> str:
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

        tests = []
        for name, locations, _, hidden in self._attempts(table):
            attempt = name.split("-")[1]
            own = ", ".join(text(f"{attempt}-{k}") for k in range(len(locations)))
            gone = "".join(f" AND NOT (job_date = DATE {text(d)} AND job_id = {text(i)})" for d, i in sorted(hidden))
            tests.append(f"(_attempt IN ({own}){gone})")
        columns = ", ".join(REJECT_SCHEMA.names)
        where = " OR ".join(tests) or "false"
        self._show(table, f"SELECT {columns} FROM `{dataset}`.`{plain}__attempts` WHERE {where}")


def _of_runs(runs: set[Run]):
    found = F.lit(False)
    for day, job_id in sorted(runs):
        found |= (F.col("job_date") == F.lit(date.fromisoformat(day))) & (F.col("job_id") == job_id)
    return found
