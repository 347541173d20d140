"""The registered queries: every operator over whole given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheetmill.functions.formats import matches, to_date, to_number, to_text
from sheetmill.functions.text import (
    blank_to_null,
    clean_cell,
    pad_cells,
    parse_key_list,
    quoted,
    row_text,
    sanitize_header,
    strip,
    value_text,
)
from sheetmill.model import REJECT_SCHEMA, ROW_ID, BadConfig, FeedConfig, FeedError, SchemaInfo
from sheetmill.operators.cast import run_slice, src_to_stg
from sheetmill.operators.control import approved_configs, blocked_feeds, gate_feeds
from sheetmill.operators.dedup import (
    dedup_rank,
    duplicate_detail,
    rej_duplicate,
    repeated_keys,
    stg_to_dw,
)
from sheetmill.operators.history import schema_changes
from sheetmill.operators.ingest import assemble, collect_headers, dedup_headers, feed_shapes
from sheetmill.operators.profile import (
    SAMPLE_LIMIT,
    cells_of,
    decide,
    infer_schema,
    infer_types,
    labelled,
    merge_votes,
    partial_votes,
    profile_sample,
    schema_groups,
    vote,
)
from sheetmill.operators.quality import reconcile, reject_summary, typed_rows
from sheetmill.operators.validate import (
    accepted,
    audit_columns,
    ext_to_src,
    load_clock,
    rej_datatype,
    reject_detail,
    rejected,
    route_rows as label_routes,
)
from sheetmill.plans import fixtures as fx
from sheetmill.plans.load import FeedResult, load_feeds
from sheetmill.rules import RuleSet
from sheetmill.session import scratch, scratch_path
from sheetmill.sources.landing import landing_path, read_landing, write_landing
from sheetmill.sources.sheets import read_sheets
from sheetmill.sources.tables import Warehouse

RULES = RuleSet.reference()
ALIGNED = RuleSet.aligned()

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        _QUERIES[name] = function
        return function

    return register


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _stg(spark: SparkSession, sf_dir: str, schema: SchemaInfo = fx.FORCED) -> DataFrame:
    return typed_rows(fx.purchases(spark, sf_dir), schema, fx.CTX, RULES, fx.DELIMITER)


def _joined(cells: Column) -> Column:
    return F.concat_ws("|", F.transform(cells, lambda c: F.coalesce(c, F.lit(""))))


# Ingest


@_query("ingest_sheet")
def ingest_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sheets")
    fx.export_sheets(spark, sf_dir, ["purchases", "suppliers"], path)
    return read_sheets(spark, path, multi_line=False).select(
        "feed", ROW_ID, F.size("cells").alias("n_cells"), _joined(F.col("cells")).alias("cells")
    )


@_query("header_sanitize")
def header_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = fx.derive(fx.table(spark, sf_dir, "part"), fx.HEADERS)
    return headers.withColumn("clean", sanitize_header(F.col("header")))


@_query("header_dedup")
def header_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_headers(header_sanitize(spark, sf_dir)).select("feed", "pos", "clean", "name")


@_query("row_pad")
def row_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.derive(fx.table(spark, sf_dir, "orders"), fx.RAGGED)
    return rows.select(
        ROW_ID,
        F.concat_ws("|", pad_cells(F.col("cells"), fx.RAGGED_WIDTH)).alias("cells"),
        (F.size("cells") > fx.RAGGED_WIDTH).alias("too_long"),
    )


@_query("cell_clean")
def cell_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = fx.derive(fx.table(spark, sf_dir, "documents"), fx.CELLS)
    return cells.select("doc_id", clean_cell(F.col("cell")).alias("cell"))


@_query("landing_roundtrip")
def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.derive(fx.table(spark, sf_dir, "documents"), fx.LANDING)
    cleaned = raw.select(*[clean_cell(quoted(c)).alias(c) for c in raw.columns])
    path = landing_path(scratch_path(spark, "landing"), "documents", fx.CTX)
    write_landing(cleaned, path, fx.DELIMITER)
    return read_landing(spark, path, raw.columns, fx.DELIMITER)


@_query("load_tmp")
def load_tmp(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sheets")
    fx.export_sheets(spark, sf_dir, ["catalogue"], path)
    rows = read_sheets(spark, path, multi_line=False)
    names = collect_headers(rows)["catalogue"]
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    first = feed_shapes(rows)["catalogue"].header
    return warehouse.replace(assemble(rows, names, first), "tmp.catalogue")


@_query("blank_to_null")
def blank_cells_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    tmp = fx.purchases(spark, sf_dir)
    blank = tmp.select(ROW_ID, *[F.coalesce(c, F.lit("")).alias(c) for c in fx.COLUMNS])
    return blank.select(ROW_ID, *[blank_to_null(quoted(c)).alias(c) for c in fx.COLUMNS])


# Profile


@_query("profile_sample")
def profile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample that a capped inference reads, up to its limit."""
    return profile_sample(fx.purchases(spark, sf_dir), limit=SAMPLE_LIMIT, seed=42)


@_query("classify_cells")
def classify_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = fx.purchases(spark, sf_dir).unpivot([ROW_ID], list(fx.COLUMNS), "col", "value")
    return labelled(cells, RULES).drop("stripped")


@_query("infer_types")
def infer_column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer_types(fx.purchases(spark, sf_dir), fx.COLUMNS, RULES)


@_query("infer_types_merged")
def infer_types_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same types from ballots that were stored for each of three ranges of rows."""
    path = scratch_path(spark, "ballots")
    cells = labelled(cells_of(fx.purchases(spark, sf_dir), fx.COLUMNS), RULES)
    for part in range(3):
        own = cells.where(F.pmod(F.floor(F.col(ROW_ID) / 1000), F.lit(3)) == part)
        partial_votes(own, ["pos"]).write.mode("append").parquet(path)
    votes = decide(merge_votes(spark.read.parquet(path), ["pos"]), ["pos"])
    names = F.array(*[F.lit(c) for c in fx.COLUMNS])
    return votes.select(F.get(names, F.col("pos")).alias("col"), *votes.columns)


@_query("schema_changes")
def schema_changes_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed in the purchases' columns from one run to the next."""
    later = fx.derive(fx.table(spark, sf_dir, "orders"), fx.DRIFTED)
    runs = [
        (fx.CTX, fx.purchases(spark, sf_dir), fx.COLUMNS),
        (fx.DRIFTED_CTX, later, fx.DRIFTED_COLUMNS),
    ]
    history = None
    for ctx, tmp, columns in runs:
        load_datetime, job_date, job_id = audit_columns(ctx)
        groups = schema_groups(infer_types(tmp, columns, RULES))
        found = groups.select(
            F.lit("purchases").alias("feed"), job_date, job_id, load_datetime, "pos", "col", "grp"
        )
        history = found if history is None else history.unionByName(found)
    return schema_changes(history)


@_query("schema_groups")
def infer_schema_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_groups(infer_column_types(spark, sf_dir))


@_query("infer_types_multi")
def infer_types_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.derive(fx.table(spark, sf_dir, "events"), fx.FEEDS)
    cells = rows.select("feed", ROW_ID, F.posexplode("cells").alias("pos", "value"))
    return vote(labelled(cells, RULES), ["feed", "pos"])


# Validate


@_query("src_project")
def src_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = fx.derive(fx.table(spark, sf_dir, "documents"), fx.LANDING)
    return cells.select(*[strip(quoted(c).cast("string")).alias(c) for c in cells.columns])


@_query("audit_columns")
def audit_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit columns of a run, and the load clock applied to every event's time."""
    return fx.table(spark, sf_dir, "events").select(
        "event_id", load_clock(F.col("ts")).alias("local_time"), *audit_columns(fx.CTX)
    )


@_query("row_text")
def raw_row_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    tmp = fx.purchases(spark, sf_dir)
    return tmp.select(ROW_ID, row_text(fx.COLUMNS, fx.DELIMITER).alias("row"))


@_query("valid_date")
def valid_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("transaction_date")
    return fx.purchases(spark, sf_dir).select(
        ROW_ID, value, matches(value, RULES.accept_date).alias("ok")
    )


@_query("valid_numeric")
def valid_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.purchases(spark, sf_dir).select(
        ROW_ID, *[matches(quoted(c), RULES.accept_numeric).alias(c) for c in fx.INFERRED.numeric]
    )


@_query("reject_numeric")
def reject_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.purchases(spark, sf_dir).select(
        ROW_ID, *[(~matches(quoted(c), RULES.reject_numeric)).alias(c) for c in fx.INFERRED.numeric]
    )


@_query("route_rows")
def route_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.purchases(spark, sf_dir).select(
        ROW_ID,
        accepted(fx.INFERRED, RULES).alias("accepted"),
        rejected(fx.INFERRED, RULES).alias("rejected"),
    )


@_query("ext_to_src")
def ext_to_src_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ext_to_src(fx.purchases(spark, sf_dir), fx.INFERRED, fx.CTX, RULES, fx.DELIMITER)


@_query("routed_rows")
def routed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TMP tested once and written by route; its parts read back."""
    path = scratch_path(spark, "routed")
    routed = label_routes(fx.purchases(spark, sf_dir), fx.INFERRED, fx.CTX, RULES, fx.DELIMITER)
    routed.write.partitionBy("_route").parquet(path)
    stored = spark.read.schema(routed.schema).parquet(path)
    parts = [stored.where(F.col("_route") == r) for r in ("src", "rej", "leaked")]
    return (
        parts[0]
        .unionByName(parts[1])
        .unionByName(parts[2])
        .select("_route", ROW_ID, *fx.COLUMNS, "row", "rej_reason", "rej_detail")
    )


@_query("reject_detail")
def reject_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.purchases(spark, sf_dir).select(
        ROW_ID, reject_detail(fx.INFERRED, RULES, fx.DELIMITER).alias("rej_detail")
    )


@_query("rej_datatype")
def rej_datatype_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rej_datatype(fx.purchases(spark, sf_dir), fx.INFERRED, fx.CTX, RULES, fx.DELIMITER)


@_query("rej_datatype_empty")
def rej_datatype_untyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed whose columns all turn out to be text: nothing can fail."""
    names = fx.derive(fx.table(spark, sf_dir, "part"), fx.TEXTS)
    schema = infer_schema(names, fx.TEXT_COLUMNS, RULES)
    return rej_datatype(names, schema, fx.CTX, RULES, fx.DELIMITER)


# Type


@_query("run_slice")
def run_slice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = fx.derive(fx.table(spark, sf_dir, "orders"), fx.RUN_ROWS)
    return run_slice(runs, fx.RUN_CTX).select(ROW_ID, *fx.COLUMNS, "job_date", "job_id")


@_query("cast_date")
def cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("transaction_date")
    return fx.purchases(spark, sf_dir).select(ROW_ID, value, to_date(value, RULES).alias("value"))


@_query("cast_numeric")
def cast_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    tmp = fx.purchases(spark, sf_dir)
    return tmp.select(ROW_ID, "amount", to_number(F.col("amount")).alias("value"))


@_query("cast_percent")
def cast_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    tmp = fx.purchases(spark, sf_dir)
    return tmp.select(ROW_ID, "discount", to_number(F.col("discount")).alias("value"))


@_query("blank_string")
def blank_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = fx.derive(fx.table(spark, sf_dir, "part"), fx.HEADERS)
    return headers.select("feed", "pos", to_text(F.col("header")).alias("value"))


@_query("src_to_stg")
def src_to_stg_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src_to_stg(ext_to_src_rows(spark, sf_dir), fx.INFERRED, fx.CTX, RULES)


# Deduplicate


@_query("dedup_rank")
def dedup_rank_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_rank(_stg(spark, sf_dir), fx.KEYS, fx.CTX).select(ROW_ID, *fx.KEYS, "rownum")


@_query("dedup_rank_blocked")
def dedup_rank_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ranks from ranges of positions so short that keys are spread over many."""
    ranked = dedup_rank(_stg(spark, sf_dir), fx.KEYS, fx.CTX, block=100)
    return ranked.select(ROW_ID, *fx.KEYS, "rownum")


@_query("dedup_null_keys")
def dedup_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tmp = fx.derive(fx.table(spark, sf_dir, "orders"), fx.NULL_KEYS)
    stg = typed_rows(tmp, fx.FORCED, fx.CTX, RULES, fx.DELIMITER)
    return dedup_rank(stg, fx.KEYS, fx.CTX).select(ROW_ID, *fx.KEYS, "rownum")


@_query("duplicate_detail")
def duplicate_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = _stg(spark, sf_dir)
    return stg.select(ROW_ID, duplicate_detail(stg, fx.KEYS, fx.DELIMITER).alias("rej_detail"))


@_query("rej_duplicate")
def rej_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys are positions that do not repeat, like those of a sheet."""
    return rej_duplicate(_stg(spark, sf_dir), fx.KEYS, fx.CTX, fx.DELIMITER, distinct_positions=True)


@_query("rej_duplicate_null_keys")
def rej_duplicate_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tmp = fx.derive(fx.table(spark, sf_dir, "orders"), fx.NULL_KEYS)
    stg = typed_rows(tmp, fx.FORCED, fx.CTX, RULES, fx.DELIMITER)
    return rej_duplicate(stg, fx.KEYS, fx.CTX, fx.DELIMITER)


@_query("stg_to_dw")
def stg_to_dw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_to_dw(_stg(spark, sf_dir), fx.FORCED, fx.KEYS, fx.CTX)


@_query("stg_to_dw_lookup")
def stg_to_dw_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same survivors, looked up in the repeated keys."""
    stg = _stg(spark, sf_dir)
    repeated = repeated_keys(stg, fx.KEYS, fx.CTX)
    return stg_to_dw(stg, fx.FORCED, fx.KEYS, fx.CTX, repeated)


# Sinks


@_query("sink_overwrite")
def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by one of another shape."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    tmp = fx.purchases(spark, sf_dir)
    warehouse.replace(tmp, "stg.purchases")
    return warehouse.replace(_stg(spark, sf_dir, fx.INFERRED), "stg.purchases")


def _append_all(spark: SparkSession, sf_dir: str, idempotent: bool) -> DataFrame:
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    tmp = fx.purchases(spark, sf_dir)
    mismatched = rej_datatype(tmp, fx.FORCED, fx.CTX, RULES, fx.DELIMITER)
    repeated = rej_duplicate_rows(spark, sf_dir)
    if idempotent:
        for _ in range(2):
            warehouse.append_rejects(mismatched.unionByName(repeated), "rej.purchases", fx.CTX)
    else:
        warehouse.append_rejects(mismatched, "rej.purchases")
        warehouse.append_rejects(repeated, "rej.purchases")
    return warehouse.read_rejects("rej.purchases")


@_query("rej_all")
def rej_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of reject appended to one table."""
    return _append_all(spark, sf_dir, idempotent=False)


@_query("rej_all_retried")
def rej_all_retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run stored twice in idempotent mode."""
    return _append_all(spark, sf_dir, idempotent=True)


# Control


def _event_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = fx.table(spark, sf_dir, "events")
    rows = events.select("event_id", F.col("event_type").alias("feed"))
    jobs = events.select("event_type").distinct().where(f"event_type <> '{fx.UNKNOWN_JOB}'")
    # Only the first entry of a job counts, so the second one must change nothing.
    control = jobs.selectExpr(
        "event_type AS job_name",
        f"explode(array(struct(1 AS pos, {fx.CONTROL_STATUS} AS status), "
        "struct(2 AS pos, 'OK' AS status))) AS entry",
    ).select("job_name", "entry.*")
    return rows, control


@_query("gate_feeds")
def gate_feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate_feeds(*_event_feeds(spark, sf_dir))


@_query("blocked_feeds")
def blocked_feed_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocked_feeds(*_event_feeds(spark, sf_dir))


@_query("parse_key_list")
def parse_key_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = fx.derive(fx.table(spark, sf_dir, "customer"), fx.KEY_LISTS)
    keys = parse_key_list(F.col("primary_keys"))
    return control.select("job_name", F.size(keys).alias("n_keys"), F.concat_ws("|", keys).alias("keys"))


def _rendered(df: DataFrame, columns: Sequence[str]) -> Column:
    values = [
        F.coalesce(value_text(quoted(c), df.schema[c].dataType), F.lit("")) for c in columns
    ]
    return F.concat_ws("|", *values)


def _loaded(
    spark: SparkSession, sf_dir: str, feeds: Sequence[str]
) -> tuple[Warehouse, list[tuple[FeedConfig, FeedResult]]]:
    """Approved feeds loaded from their exported sheets. One control row is unusable."""
    configs = approved_configs(fx.control_sheet(spark))
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    with scratch(spark, "sheets") as sheets:
        fx.export_sheets(spark, sf_dir, list(feeds), sheets)
        results = load_feeds(spark, sheets, configs, fx.CTX, warehouse, RULES, multi_line=False)
    done = []
    for config in configs:
        result = results[config.job_name]
        if isinstance(config, BadConfig):
            if result.error is None:
                raise FeedError(f"{config.job_name}: an unusable job ran")
        elif config.job_name in feeds:
            if result.error:
                raise result.error
            done.append((config, result))
    return warehouse, done


@_query("load_counts")
def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load of the purchases counted in each layer."""
    _, [(_, result)] = _loaded(spark, sf_dir, ["purchases"])
    counts = {k: n for k, n in result.counts.items() if k != "surplus"}
    return spark.createDataFrame(list(counts.items()), "layer string, n_rows long")


@_query("multi_feed_dw")
def multi_feed_dw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every approved feed loaded from its exported sheet; the DW rows as text."""
    warehouse, done = _loaded(spark, sf_dir, list(fx.SHEETS))
    tables = []
    for config, result in done:
        dw = warehouse.read(config.tables["dw"])
        tables.append(
            dw.select(
                F.lit(config.job_name).alias("feed"),
                _rendered(dw, result.schema.definition).alias("dw_row"),
                "job_id",
            )
        )
    merged = tables[0]
    for other in tables[1:]:
        merged = merged.unionByName(other)
    return merged


@_query("purchases_dw")
def purchases_dw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: infer the columns, validate, type and deduplicate the purchases."""
    tmp = fx.purchases(spark, sf_dir)
    schema = infer_schema(tmp, fx.COLUMNS, RULES)
    return stg_to_dw(typed_rows(tmp, schema, fx.CTX, RULES), schema, fx.KEYS, fx.CTX)


@_query("purchases_rejects")
def purchases_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rejects of the flagship run."""
    tmp = fx.purchases(spark, sf_dir)
    schema = infer_schema(tmp, fx.COLUMNS, RULES)
    stg = typed_rows(tmp, schema, fx.CTX, RULES)
    mismatched = rej_datatype(tmp, schema, fx.CTX, RULES)
    return mismatched.unionByName(rej_duplicate(stg, fx.KEYS, fx.CTX)).select(*REJECT_SCHEMA.names)


# Audit


@_query("reject_summary")
def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tmp = fx.purchases(spark, sf_dir)
    stg = typed_rows(tmp, fx.INFERRED, fx.CTX, RULES)
    return reject_summary(tmp, stg, fx.INFERRED, fx.KEYS, fx.CTX, RULES)


@_query("reconcile")
def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tmp = fx.purchases(spark, sf_dir)
    stg = typed_rows(tmp, fx.INFERRED, fx.CTX, RULES)
    return reconcile(tmp, stg, fx.INFERRED, fx.KEYS, fx.CTX, RULES)


@_query("reconcile_forced")
def reconcile_forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    tmp = fx.purchases(spark, sf_dir)
    return reconcile(tmp, _stg(spark, sf_dir), fx.FORCED, fx.KEYS, fx.CTX, RULES)


# Aligned rules


@_query("aligned_types")
def aligned_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer_types(fx.purchases(spark, sf_dir), fx.COLUMNS, ALIGNED)


@_query("aligned_dw")
def aligned_dw(spark: SparkSession, sf_dir: str) -> DataFrame:
    tmp = fx.purchases(spark, sf_dir)
    schema = infer_schema(tmp, fx.COLUMNS, ALIGNED)
    return stg_to_dw(typed_rows(tmp, schema, fx.CTX, ALIGNED), schema, fx.KEYS, fx.CTX)


@_query("aligned_rejects")
def aligned_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rej_datatype(fx.purchases(spark, sf_dir), fx.INFERRED, fx.CTX, ALIGNED, fx.DELIMITER)


@_query("aligned_reconcile")
def aligned_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    tmp = fx.purchases(spark, sf_dir)
    stg = typed_rows(tmp, fx.INFERRED, fx.CTX, ALIGNED)
    return reconcile(tmp, stg, fx.INFERRED, fx.KEYS, fx.CTX, ALIGNED)
