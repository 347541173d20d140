"""Loading one or many feeds through TMP, SRC, STG, DW and the rejects.

Feeds with the same columns, types and keys make a batch: each layer of a batch is one job that writes a part per feed, and
a feed's tables point at its parts. So jobs grow with the kinds of feeds and not with their number. Batches run side by
side. What a batch has finished is in the run's ledger, from which a repeated load goes on.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sheetmill.model import (
    REJECT_SCHEMA,
    ROW_ID,
    BadConfig,
    FeedConfig,
    FeedError,
    RunContext,
    SchemaInfo,
)
from sheetmill.operators.cast import src_to_stg
from sheetmill.operators.dedup import rej_duplicate, stg_to_dw
from sheetmill.operators.ingest import (
    FeedShape,
    assemble,
    collect_headers,
    feed_shapes,
    require_data,
    surplus_rejects,
)
from sheetmill.operators.profile import infer_feed_schemas, infer_schema
from sheetmill.operators.validate import route_rows
from sheetmill.plans.ledger import Ledger, ledger_time
from sheetmill.rules import RuleSet
from sheetmill.session import files_of, scratch
from sheetmill.sources.sheets import read_sheets
from sheetmill.sources.tables import Warehouse, run_key

#: The column that tells a batch's feeds apart, and the layers of a batch in the order in which they are finished.
PART = "_part"
LAYERS = ("tmp", "route", "stg", "end")

_STAGED = T.StructType(
    [
        T.StructField(ROW_ID, T.LongType()),
        T.StructField("cells", T.ArrayType(T.StringType())),
        T.StructField("doc_first", T.LongType()),
        T.StructField("doc_last", T.LongType()),
        T.StructField("feed", T.StringType()),
    ]
)


@dataclass(frozen=True)
class FeedResult:
    """Outcome of one feed; ``error`` is set when it could not be loaded.

    ``counts`` has the rows of each layer: ``surplus`` ones have more cells than the header and
    are rejected before TMP; tmp = src + rej_datatype + leaked; src = dw + rej_duplicate.
    """

    job_name: str
    schema: SchemaInfo | None = None
    counts: Mapping[str, int] = field(default_factory=dict)
    error: Exception | None = None


def stage_rows(rows: DataFrame, path: str) -> DataFrame:
    """Write sheet rows by feed, so headers and single feeds are read without the rest.

    A document is parsed by one task, so its rows are dealt out again first.
    """
    dealt = rows.select(*_STAGED.names).hint("rebalance", "feed")
    dealt.write.mode("overwrite").partitionBy("feed").parquet(path)
    return rows.sparkSession.read.schema(_STAGED).parquet(path)


def require_own_tables(configs: Sequence[FeedConfig], idempotent: bool) -> None:
    """Stop when one feed's load would replace what another feed wrote."""
    replaced = [c.tables[layer] for c in configs for layer in ("tmp", "src", "stg", "dw")]
    if idempotent:
        replaced += [c.tables["rej"] for c in configs]
    shared = sorted(table for table, n in Counter(replaced).items() if n > 1)
    if shared:
        raise FeedError(f"tables are replaced by more than one load: {shared}")


def feed_tag(ctx: RunContext, job: str) -> str:
    """The tag of all jobs that load a feed in a run."""
    return re.sub(r"[^A-Za-z0-9_.-]", "_", f"sheetmill-{ctx.job_date:%Y%m%d}-{ctx.job_id}-{job}")


def cancel_feed(spark: SparkSession, ctx: RunContext, job: str) -> None:
    """Stop the running jobs of a feed; its load ends with an error, and so do those of its batch."""
    spark.sparkContext.cancelJobsWithTag(feed_tag(ctx, job))


@dataclass(frozen=True)
class Batch:
    """Feeds with the same columns, types, keys, delimiter and header position: part i is feed i."""

    name: str
    configs: tuple[FeedConfig, ...]
    schema: SchemaInfo
    header: int = 0
    surplus: bool = True

    @property
    def keys(self) -> tuple[str, ...]:
        return self.configs[0].primary_key

    @property
    def delimiter(self) -> str:
        return self.configs[0].delimiter


class _BatchLoad:
    """Carries one batch from its staged rows to its last layer.

    ``done`` are the ledger's records of layers that an earlier load of the run has finished.
    """

    def __init__(
        self,
        batch: Batch,
        ctx: RunContext,
        warehouse: Warehouse,
        rules: RuleSet,
        ledger: Ledger,
        idempotent: bool,
        done: Mapping[str, Mapping[str, Any]] | None = None,
    ):
        self.batch, self.ctx, self.rules = batch, ctx, rules
        self.warehouse, self.ledger, self.idempotent = warehouse, ledger, idempotent
        self.spark = warehouse.spark
        self.base = f"{warehouse.store}/_batches/{batch.name}"
        self.counts: dict[str, dict[str, int]] = {c.job_name: {} for c in batch.configs}
        self.done = dict(done or {})
        for record in self.done.values():
            for feed in record["feeds"]:
                self.counts[feed["job"]].update(feed["counts"])

    @contextmanager
    def _named(self):
        """Jobs of this thread carry the tags of the batch's feeds and share a scheduler pool."""
        context = self.spark.sparkContext
        tags = {feed_tag(self.ctx, c.job_name) for c in self.batch.configs}
        context.setLocalProperty("spark.scheduler.pool", self.batch.configs[0].job_name)
        for tag in tags:
            context.addJobTag(tag)
        try:
            yield
        finally:
            for tag in tags:
                context.removeJobTag(tag)
            context.setLocalProperty("spark.scheduler.pool", None)

    def _folder(self, layer: str, part: int, *more: str) -> str:
        return "/".join([self.base, layer, f"{PART}={part}", *more])

    def _write(self, df: DataFrame, layer: str, by: str | None = None) -> T.StructType:
        """Write ``df``, whose last columns are the part and ``by``; returns the columns of a part."""
        columns = df.schema
        if len(self.batch.configs) == 1:
            # No part column, so that no sort by it is needed.
            df, path = df.drop(PART), self._folder(layer, 0)
            (df.write.partitionBy(by) if by else df.write).parquet(path)
        else:
            df.write.partitionBy(*[PART, by] if by else [PART]).parquet(f"{self.base}/{layer}")
        return T.StructType([f for f in columns if f.name not in (PART, by)])

    def _read(self, columns: T.StructType, layer: str, by: str | None = None) -> DataFrame:
        """A written layer of all feeds, with their parts."""
        for part in range(len(self.batch.configs)):
            self._made(self._folder(layer, part))
        own = T.StructType([*columns, T.StructField(PART, T.IntegerType())])
        if by:
            own = own.add(by, T.StringType())
        return self.spark.read.schema(own).parquet(f"{self.base}/{layer}")

    def _made(self, folder: str) -> str:
        """The folder, which a feed without such rows has not got yet."""
        files, location = files_of(self.spark, folder)
        files.mkdirs(location)
        return folder

    def _drop(self, folder: str) -> None:
        files, location = files_of(self.spark, folder)
        files.delete(location, True)

    def _count(self, rows: DataFrame, **names: str) -> None:
        """Count rows per feed, and per route where names are given for routes."""
        kind = F.col("_route") if len(names) > 1 else F.lit(next(iter(names)))
        found = rows.groupBy(PART, kind.alias("kind"))
        for counts in self.counts.values():
            counts.update(dict.fromkeys(names.values(), 0))
        for r in found.count().collect():  # a row per feed and route
            if r["kind"] in names:
                self.counts[self.batch.configs[r[PART]].job_name][names[r["kind"]]] = r["count"]

    def _publish(self, layer: str, columns: T.StructType, folder: Callable[[int], str]) -> None:
        for part, config in enumerate(self.batch.configs):
            self.warehouse.publish(config.tables[layer], self._made(folder(part)), columns)

    def _finish(self, layer: str, names: Sequence[str], **columns: T.StructType) -> None:
        feeds = [
            {
                "job": c.job_name,
                "tables": dict(c.tables),
                "locations": {t: self.warehouse.location(c.tables[t]) for t in _tables_of(layer)},
                "counts": {n: self.counts[c.job_name][n] for n in names},
            }
            for c in self.batch.configs
        ]
        schema, group = self.batch.schema, {}
        group.update(dict.fromkeys(schema.date, "date"), **dict.fromkeys(schema.numeric, "numeric"))
        value = {
            "feeds": feeds,
            "columns": [{"col": c, "pos": i, "grp": group.get(c)} for i, c in enumerate(schema.definition)],
            "keys": list(self.batch.keys),
            "delimiter": self.batch.delimiter,
            "header": self.batch.header,
            "surplus": self.batch.surplus,
            "rules": repr(self.rules),
            "schemas": {name: s.jsonValue() for name, s in columns.items()},
        }
        self.ledger.add(self.ctx, self.batch.name, layer, value)
        self.done[layer] = value

    def _columns(self, layer: str, name: str) -> T.StructType:
        return T.StructType.fromJson(self.done[layer]["schemas"][name])

    def _tmp(self, staged: DataFrame) -> None:
        batch = self.batch
        jobs = [c.job_name for c in batch.configs]
        parts = F.create_map(*[F.lit(x) for part, job in enumerate(jobs) for x in (job, part)])
        part = (F.lit(0) if len(jobs) == 1 else F.element_at(parts, F.col("feed"))).alias(PART)
        rows = staged.filter(F.col("feed").isin(jobs))
        wide = assemble(rows, batch.schema.definition, batch.header, part)
        columns = self._write(wide, "tmp")
        self._count(self._read(columns, "tmp"), tmp="tmp")
        self.counts = {job: {**counts, "surplus": 0} for job, counts in self.counts.items()}
        found = None
        if batch.surplus:
            surplus = surplus_rejects(
                rows, batch.schema.definition, self.ctx, batch.delimiter, batch.header, part
            )
            found = self._write(surplus, "surplus")
            self._count(self._read(found, "surplus"), surplus="surplus")
        self._publish("tmp", columns, lambda part: self._folder("tmp", part))
        self._finish("tmp", ["tmp", "surplus"], tmp=columns, **({"surplus": found} if found else {}))

    def _route(self) -> None:
        batch, schema = self.batch, self.batch.schema
        tmp = self._read(self._columns("tmp", "tmp"), "tmp")
        routed = route_rows(tmp, schema, self.ctx, self.rules, batch.delimiter, F.col(PART), stripped=True)
        columns = self._write(routed, "route", "_route")
        self._count(self._read(columns, "route", "_route"), src="src", rej="rej_datatype", leaked="leaked")
        for part in range(len(batch.configs)):
            self._drop(self._folder("route", part, "_route=leaked"))
        src = T.StructType([f for f in columns if f.name not in ("rej_reason", "rej_detail")])
        self._publish("src", src, lambda part: self._folder("route", part, "_route=src"))
        self._finish("route", ["src", "rej_datatype", "leaked"], src=src)

    def _stg(self) -> None:
        routed = self._read(self._columns("route", "src"), "route", "_route")
        src = routed.where("_route = 'src'")
        typed = src_to_stg(src, self.batch.schema, self.ctx, self.rules, F.col(PART))
        columns = self._write(typed, "stg")
        self._publish("stg", columns, lambda part: self._folder("stg", part))
        self._finish("stg", [], stg=columns)

    def _end(self) -> None:
        """Survivors and rejected copies, side by side."""
        batch = self.batch
        rejects = [self._rejects(part) for part in range(len(batch.configs))]
        committed = self.committed()  # an attempt that failed later must not touch them again
        stg = self._read(self._columns("stg", "stg"), "stg")
        # One feed's keys are its own already.
        within = [PART] if len(batch.configs) > 1 else []

        def survivors() -> T.StructType:
            with self._named():
                kept = stg_to_dw(stg, batch.schema, batch.keys, self.ctx, within=within)
                columns = self._write(kept, "dw")
                self._count(self._read(columns, "dw"), dw="dw")
                return columns

        def copies() -> None:
            with self._named():
                if not committed:
                    self._drop(f"{self.base}/copies")
                    copies = rej_duplicate(
                        stg, batch.keys, self.ctx, batch.delimiter, distinct_positions=True, within=within
                    )
                    self._write(copies.hint("rebalance"), "copies")
                self._count(self._read(REJECT_SCHEMA, "copies"), copies="rej_duplicate")

        with ThreadPoolExecutor(2) as pool:
            rejecting = pool.submit(copies)
            columns = survivors()
            rejecting.result()
        self._publish("dw", columns, lambda part: self._folder("dw", part))
        for config, places in zip(batch.configs, rejects):
            self.warehouse.commit_rejects(
                config.tables["rej"],
                list(map(self._made, places)),
                [run_key(self.ctx)],
                self.ctx if self.idempotent else None,
            )
        self._finish("end", ["rej_duplicate", "dw"], dw=columns)

    def committed(self) -> bool:
        """Whether rejects of any of the feeds count already."""
        return any(
            self.warehouse.holds_rejects(c.tables["rej"], self._rejects(part))
            for part, c in enumerate(self.batch.configs)
        )

    def _rejects(self, part: int) -> list[str]:
        """The folders of a feed's rejects."""
        places = [self._folder("route", part, "_route=rej"), self._folder("copies", part)]
        return places + ([self._folder("surplus", part)] if self.batch.surplus else [])

    def run(self, staged: DataFrame | None) -> dict[str, FeedResult]:
        steps = {"tmp": lambda: self._tmp(staged), "route": self._route, "stg": self._stg, "end": self._end}
        try:
            for layer, step in steps.items():
                if layer not in self.done:
                    # What an attempt that failed has left there.
                    for name in (layer, *{"tmp": ["surplus"], "end": ["dw"]}.get(layer, [])):
                        self._drop(f"{self.base}/{name}")
                    with self._named():
                        step()
        except Exception as error:  # one feed must not stop the others
            return {c.job_name: FeedResult(c.job_name, self.batch.schema, error=error) for c in self.batch.configs}
        return {
            job: FeedResult(job, self.batch.schema, {n: counts[n] for n in COUNTS}) for job, counts in self.counts.items()
        }


#: What a load counts, in the order of a result.
COUNTS = ("tmp", "src", "rej_datatype", "rej_duplicate", "surplus", "dw", "leaked")


def _tables_of(layer: str) -> tuple[str, ...]:
    return {"tmp": ("tmp",), "route": ("src",), "stg": ("stg",), "end": ("dw",)}[layer]


def _begun(
    ledger: Ledger, ctx: RunContext, configs: Mapping[str, FeedConfig], warehouse: Warehouse, rules: RuleSet
) -> list[tuple[Batch, dict]]:
    """Batches of an earlier load of the run that can go on: their feeds are configured as they were, and the tables of
    their finished layers are still theirs."""
    found: dict[str, tuple[Batch, dict]] = {}
    for name, layers in ledger.batches(ctx).items():
        first = layers.get("tmp")
        jobs = [f["job"] for f in first["feeds"]] if first else []
        if not first or first["rules"] != repr(rules) or any(j not in configs for j in jobs):
            continue
        own = tuple(configs[j] for j in jobs)
        same = all(
            dict(c.tables) == f["tables"] and list(c.primary_key) == first["keys"] and c.delimiter == first["delimiter"]
            for c, f in zip(own, first["feeds"])
        )
        done: dict = {}
        for layer in LAYERS:
            if layer not in layers or not all(
                warehouse.location(f["tables"][t]) == f["locations"][t]
                for f in layers[layer]["feeds"]
                for t in _tables_of(layer)
            ):
                break
            done[layer] = layers[layer]
        if not same or "tmp" not in done:
            continue
        columns = first["columns"]
        groups = {g: tuple(c["col"] for c in columns if c["grp"] == g) for g in ("date", "numeric")}
        schema = SchemaInfo(tuple(c["col"] for c in columns), groups["date"], groups["numeric"])
        batch = Batch(name, own, schema, first["header"], first["surplus"])
        for other in [n for n, (b, _) in found.items() if {c.job_name for c in b.configs} & set(jobs)]:
            del found[other]  # an older load of the same feeds
        found[name] = (batch, done)
    return list(found.values())


def _batches(
    configs: Sequence[FeedConfig], schemas: Mapping[str, SchemaInfo], shapes: Mapping[str, FeedShape]
) -> list[Batch]:
    """Feeds put together by their columns, types, keys, delimiter and header position."""
    alike: dict[tuple, list[FeedConfig]] = {}
    for c in configs:
        alike.setdefault((schemas[c.job_name], c.primary_key, c.delimiter, shapes[c.job_name].header), []).append(c)
    found = []
    for (schema, _, _, header), own in alike.items():
        widest = max(w or 0 for c in own for w in shapes[c.job_name].widths)
        surplus = widest > len(schema.definition)
        found.append(Batch(uuid.uuid4().hex, tuple(own), schema, header, surplus))
    return found


def load_feeds(
    spark: SparkSession,
    sheets: str,
    configs: Sequence[FeedConfig | BadConfig],
    ctx: RunContext,
    warehouse: Warehouse,
    rules: RuleSet | None = None,
    multi_line: bool = True,
    sample_limit: int | None = None,
    idempotent: bool = False,
    parallel: int = 4,
    resume: bool = False,
    ledger: Ledger | None = None,
) -> dict[str, FeedResult]:
    """Load every configured feed found below ``sheets`` (one folder per job name).

    Exports are parsed once. Headers, row shapes and column types of all feeds come from a few
    jobs, however many feeds there are; so do the layers of feeds that are alike. Batches of such feeds are loaded
    a few at a time, and one that fails is tried again feed by feed and does not stop the others.

    With ``resume`` a run of the same date and id goes on after the layers that it has finished, with its own load
    time: their tables are not written again, and the exports of such feeds are not read.
    """
    good = [c for c in configs if isinstance(c, FeedConfig)]
    require_own_tables(good, idempotent)
    rules = rules or RuleSet.reference()
    ledger = ledger or Ledger(spark, f"{warehouse.store}/_ledger")
    results = {c.job_name: FeedResult(c.job_name, error=c.error) for c in configs if isinstance(c, BadConfig)}
    by_job = {c.job_name: c for c in good}
    begun = _begun(ledger, ctx, by_job, warehouse, rules) if resume else []
    if begun:
        ctx = replace(ctx, load_datetime=ledger_time(begun[0][1]["tmp"]))

    def load(batch: Batch, done: dict | None, staged: DataFrame | None) -> dict[str, FeedResult]:
        own = _BatchLoad(batch, ctx, warehouse, rules, ledger, idempotent, done)
        found = own.run(staged)
        failed = next((r.error for r in found.values() if r.error), None)
        if failed is None or len(batch.configs) == 1 or staged is None or own.committed():
            return found
        # One of the feeds may be at fault; it must not stop the others. Had rejects been committed, they would be
        # added again; the run can be resumed instead.
        alone = [replace(batch, name=uuid.uuid4().hex, configs=(c,)) for c in batch.configs]
        return {job: r for one in alone for job, r in load(one, None, staged).items()}

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        going_on = [pool.submit(load, batch, done, None) for batch, done in begun]
        ahead = {c.job_name for batch, _ in begun for c in batch.configs}
        todo = [c for c in good if c.job_name not in ahead]
        if todo:
            with scratch(spark, "staged") as path:
                batches, staged, failed = _prepare(
                    spark, sheets, todo, rules, multi_line, sample_limit, path
                )
                results.update(failed)
                for found in pool.map(lambda b: load(b, None, staged), batches):
                    results.update(found)
        for future in going_on:
            results.update(future.result())
    return {c.job_name: results[c.job_name] for c in configs}


def _prepare(
    spark: SparkSession,
    sheets: str,
    configs: Sequence[FeedConfig],
    rules: RuleSet,
    multi_line: bool,
    sample_limit: int | None,
    path: str,
) -> tuple[list[Batch], DataFrame, dict[str, FeedResult]]:
    """Stage the exports and find what each feed holds; feeds that cannot be loaded come with their error."""
    rows = read_sheets(spark, sheets, multi_line, mark_damaged=True)
    staged = stage_rows(rows.filter(F.col("feed").isin([c.job_name for c in configs])), path)
    headers = collect_headers(staged)
    shapes = feed_shapes(staged)
    inferred = infer_feed_schemas(staged, headers, rules) if sample_limit is None else {}
    schemas: dict[str, SchemaInfo] = {}
    failed: dict[str, FeedResult] = {}
    for config in configs:
        job = config.job_name
        try:
            if job in shapes:
                shapes[job].require_whole()
            require_data([job], headers)
            schema = inferred.get(job)
            if isinstance(schema, Exception):
                raise schema
            # Before any table is touched.
            SchemaInfo(tuple(headers[job])).require_keys(config.primary_key)
            if schema is None:
                own = staged.filter(F.col("feed") == job)
                wide = assemble(own, headers[job], shapes[job].header)
                schema = infer_schema(wide, headers[job], rules, sample_limit=sample_limit)
            schemas[job] = schema
        except Exception as error:  # one feed must not stop the others
            failed[job] = FeedResult(job, error=error)
    return _batches([c for c in configs if c.job_name in schemas], schemas, shapes), staged, failed
