"""Driver-side values that describe a feed, its columns and one run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from typing import Any
from zoneinfo import ZoneInfo

from pyspark.sql import types as T

from sheetmill.rules import LOAD_ZONE

#: Position of a row within its feed. Rides along from TMP to STG; unique within a feed and
#: used to settle ties. Never part of a feed's own columns.
ROW_ID = "_src_row"

AUDIT_COLUMNS = ("load_datetime", "job_date", "job_id")
RESERVED_COLUMNS = (*AUDIT_COLUMNS, "row", ROW_ID)

REJECT_SCHEMA = T.StructType(
    [
        T.StructField("row", T.StringType()),
        T.StructField("rej_reason", T.StringType()),
        T.StructField("rej_detail", T.StringType()),
        T.StructField("load_datetime", T.TimestampNTZType()),
        T.StructField("job_date", T.DateType()),
        T.StructField("job_id", T.StringType()),
    ]
)


class FeedError(ValueError):
    """A feed cannot be loaded as configured."""


@dataclass(frozen=True)
class SchemaInfo:
    """Ordered columns of a feed and the ones treated as dates or numbers."""

    definition: tuple[str, ...]
    date: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        repeated = sorted({c for c in self.definition if self.definition.count(c) > 1})
        if repeated:
            raise FeedError(f"column names repeat after cleaning: {repeated}")
        reserved = sorted(set(self.definition) & set(RESERVED_COLUMNS))
        if reserved:
            raise FeedError(f"column names collide with audit columns: {reserved}")
        unknown = sorted({*self.date, *self.numeric} - set(self.definition))
        if unknown:
            raise FeedError(f"typed columns are not in the definition: {unknown}")

    @property
    def typed(self) -> tuple[str, ...]:
        return (*self.date, *self.numeric)

    def require_keys(self, keys: Sequence[str]) -> None:
        if not keys:
            raise FeedError("no primary key is configured")
        missing = [k for k in keys if k not in self.definition]
        if missing:
            raise FeedError(f"primary key columns are missing from the feed: {missing}")


@dataclass(frozen=True)
class RunContext:
    """Identity of one run; the clock is read once so every table of the run agrees."""

    job_id: str
    job_date: date
    load_datetime: datetime

    @classmethod
    def of(cls, job_id: str, ds_nodash: str, load_datetime: datetime | None = None) -> RunContext:
        now = load_datetime or datetime.now(ZoneInfo(LOAD_ZONE)).replace(tzinfo=None)
        return cls(job_id, datetime.strptime(ds_nodash, "%Y%m%d").date(), now)


@dataclass(frozen=True)
class FeedConfig:
    """What to load, where to put each layer, and the business key."""

    job_name: str
    tables: Mapping[str, str]
    primary_key: tuple[str, ...]
    delimiter: str = "|"
    schedule: str | None = None
    source: Mapping[str, str] = field(default_factory=dict)

    LAYERS = ("tmp", "src", "stg", "dw", "rej")

    def __post_init__(self) -> None:
        missing = [layer for layer in self.LAYERS if not self.tables.get(layer)]
        if missing:
            raise FeedError(f"job {self.job_name!r} names no table for: {missing}")
        if not self.delimiter:
            raise FeedError(f"job {self.job_name!r} has no field delimiter")

    @classmethod
    def from_dict(cls, config: Mapping[str, Any]) -> FeedConfig:
        """Read the nested layout used in configuration files."""
        return cls(
            job_name=config["job_name"],
            schedule=config.get("schedule"),
            delimiter=config["dag_params"]["field_delimiter"],
            source=dict(config.get("gsheet") or {}),
            tables=dict(config["bq_tables"]),
            primary_key=tuple(config["bq_schema"]["primary_key"] or ()),
        )

    @classmethod
    def from_control_row(cls, row: Mapping[str, Any]) -> FeedConfig:
        """Build from a control-sheet row whose key list is already an array."""
        return cls(
            job_name=row["job_name"],
            schedule=row["schedule"],
            delimiter=row["field_delimiter"],
            source={"gsheet_id": row["gsheet_id"], "range": row["range"]},
            tables={layer: row[f"{layer}_table"] for layer in cls.LAYERS},
            primary_key=tuple(row["primary_keys"]),
        )


@dataclass(frozen=True)
class BadConfig:
    """A job that cannot be configured; its load only reports why."""

    job_name: str
    error: Exception


def load_configs(folder: str) -> list[FeedConfig | BadConfig]:
    """Read every ``*.yaml`` configuration of a folder (needs PyYAML).

    One that cannot be read becomes a ``BadConfig`` named like its file.
    """
    from pathlib import Path

    import yaml

    found: list[FeedConfig | BadConfig] = []
    for path in sorted(Path(folder).glob("*.yaml")):
        try:
            found.append(FeedConfig.from_dict(yaml.safe_load(path.read_text())))
        except Exception as error:  # one file must not stop the others
            found.append(BadConfig(path.stem, error))
    return found
