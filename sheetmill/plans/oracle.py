"""Plain SQL that computes each registered query again in the checking engine.

engines share. No format pattern or expression of the Spark side is used here.
"""

from __future__ import annotations

from collections.abc import Iterable

from sheetmill.plans import fixtures as fx

_SPACE = (
    r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_DATE = r"^([0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/([0-9]{2}|[0-9]{4}))$"
_ACCEPT = r"^[0-9]+(\.[0-9]+)?%?$"
_REJECT = r"^[0-9,]+(\.[0-9]+)?%?$"
_ALIGNED_DATE = (
    r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}"
    r"|[0-9]{1,2}/[0-9]{1,2}/([0-9]{2}|[0-9]{4}))$"
)
_GROUPED = r"([0-9]+|[0-9]{1,3}(,[0-9]{3})+)"
_ALIGNED_NUMBER = rf"^{_GROUPED}(\.[0-9]+)?%?$"
_LABELS = (
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "DATE"),
    (r"^[0-9]+(\.[0-9]+)?%$", "FLOAT"),
    (r"^[0-9]+$", "INT64"),
    (r"^[0-9]+(\.[0-9]+)?$", "FLOAT"),
)
_ALIGNED_LABELS = (
    (_ALIGNED_DATE, "DATE"),
    (rf"^{_GROUPED}(\.[0-9]+)?%$", "FLOAT"),
    (rf"^{_GROUPED}$", "INT64"),
    (rf"^{_GROUPED}(\.[0-9]+)?$", "FLOAT"),
)
_AUDIT = "TIMESTAMP '2024-01-05 07:00:00' AS load_datetime, DATE '2024-01-05' AS job_date, 'run_1' AS job_id"


def _array(rule: str) -> str:
    return rule.replace("ARRAY(", "list_value(")


def _fixture(name: str, rules: dict[str, str], table: str) -> str:
    columns = ",\n  ".join(f'{_array(rule)} AS "{column}"' for column, rule in rules.items())
    return f"{name} AS (SELECT {columns}\nFROM {table})"


def _with(parts: Iterable[str], query: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + query


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def _clean(x: str) -> str:
    return _strip(f"replace({x}, chr(10), ' ')")


def _header(x: str) -> str:
    text = f"regexp_replace(coalesce({x}, 'None'), '[^a-zA-Z0-9_]', '_', 'g')"
    name = f"lower(trim(regexp_replace({text}, '_+', '_', 'g'), '_'))"
    return f"CASE WHEN {name} = '' THEN 'col' ELSE {name} END"


def _joined(cells: str) -> str:
    return f"array_to_string(list_transform({cells}, lambda c: coalesce(c, '')), '|')"


def _label(x: str, labels=_LABELS) -> str:
    tests = " ".join(
        f"WHEN regexp_matches({_strip(x)}, '{pattern}') THEN '{label}'" for pattern, label in labels
    )
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL {tests} ELSE 'STRING' END"


def _is_date(c: str, pattern: str = _DATE) -> str:
    return f"regexp_matches(coalesce({c}, '12/31/2999'), '{pattern}')"


def _is_number(c: str, pattern: str) -> str:
    return f"regexp_matches(coalesce({c}, '0'), '{pattern}')"


def _date_value(c: str, aligned: bool = False) -> str:
    more = ""
    if aligned:
        more = (
            f"WHEN regexp_matches({c}, '^[0-9]{{4}}-') THEN CAST(try_strptime({c}, '%Y-%m-%d') AS DATE) "
            f"WHEN regexp_matches({c}, '^[0-9]+-[A-Za-z]') THEN CAST(try_strptime({c}, '%d-%b-%Y') AS DATE) "
        )
    return (
        f"CASE WHEN {c} IS NULL OR {c} = '' THEN NULL {more}"
        f"WHEN regexp_matches({c}, '/[0-9]{{4}}$') THEN CAST(try_strptime({c}, '%m/%d/%Y') AS DATE) "
        f"ELSE CAST(try_strptime({c}, '%m/%d/%y') AS DATE) END"
    )


def _number_value(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL OR {c} = '' THEN NULL "
        f"WHEN right({c}, 1) = '%' THEN TRY_CAST(replace(replace({c}, '%', ''), ',', '') AS DOUBLE) / 100 "
        f"ELSE TRY_CAST(replace({c}, ',', '') AS DOUBLE) END"
    )


def _double_text(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '\\.0$', '')"


def _row(columns: Iterable[str]) -> str:
    return " || '|' || ".join(f"coalesce({c}, '')" for c in columns)


class _Feed:
    """The layers of one feed as common table expressions."""

    def __init__(self, columns, date, numeric, keys, tmp="tmp", aligned=False):
        self.columns, self.date, self.numeric, self.keys = columns, date, numeric, keys
        self.tmp, self.aligned = tmp, aligned
        self.date_pattern = _ALIGNED_DATE if aligned else _DATE
        self.accept_pattern = _ALIGNED_NUMBER if aligned else _ACCEPT
        self.reject_pattern = _ALIGNED_NUMBER if aligned else _REJECT

    @property
    def accepted(self) -> str:
        tests = [_is_date(c, self.date_pattern) for c in self.date]
        tests += [_is_number(c, self.accept_pattern) for c in self.numeric]
        return " AND ".join(["1 = 1", *tests])

    @property
    def failures(self) -> dict[str, str]:
        found = {c: f"NOT {_is_date(c, self.date_pattern)}" for c in self.date}
        found |= {c: f"NOT {_is_number(c, self.reject_pattern)}" for c in self.numeric}
        return found

    @property
    def rejected(self) -> str:
        return " OR ".join(["1 = 0", *self.failures.values()])

    @property
    def detail(self) -> str:
        parts = [f"CASE WHEN {t} THEN '{c}: ' || {c} END" for c, t in self.failures.items()]
        return f"concat_ws('|', {', '.join(parts)})" if parts else "''"

    def src(self) -> str:
        columns = ", ".join(f"{_strip(c)} AS {c}" for c in self.columns)
        return (
            f"src AS (SELECT {columns}, {_AUDIT}, {_row(self.columns)} AS row, _src_row "
            f"FROM {self.tmp} WHERE {self.accepted})"
        )

    def rej_datatype(self) -> str:
        return (
            f"rej_datatype AS (SELECT {_row(self.columns)} AS row, 'DATATYPE MISMATCH' AS rej_reason, "
            f"{self.detail} AS rej_detail, {_AUDIT} FROM {self.tmp} WHERE {self.rejected})"
        )

    def value(self, c: str) -> str:
        if c in self.date:
            return _date_value(c, self.aligned)
        if c in self.numeric:
            return _number_value(c)
        return f"CASE WHEN {c} IS NOT NULL AND {c} <> '' THEN {c} ELSE NULL END"

    def stg(self) -> str:
        columns = ", ".join(f"{self.value(c)} AS {c}" for c in self.columns)
        return (
            f"stg AS (SELECT {columns}, load_datetime, job_date, job_id, row, _src_row FROM src "
            "WHERE job_id = 'run_1' AND job_date = DATE '2024-01-05')"
        )

    def ranked(self) -> str:
        return (
            f"ranked AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(self.keys)} "
            "ORDER BY job_id DESC, _src_row) AS rownum FROM stg)"
        )

    def text(self, c: str) -> str:
        return _double_text(c) if c in self.numeric else f"CAST({c} AS VARCHAR)"

    @property
    def key_detail(self) -> str:
        return " || '|' || ".join(f"'{k}: ' || coalesce({self.text(k)}, 'NULL')" for k in self.keys)

    def rej_duplicate(self) -> str:
        return (
            f"rej_duplicate AS (SELECT row, 'DUPLICATE RECORD' AS rej_reason, {self.key_detail} "
            f"AS rej_detail, {_AUDIT} FROM ranked WHERE rownum > 1)"
        )

    def dw(self) -> str:
        return (
            f"dw AS (SELECT {', '.join(self.columns)}, load_datetime, job_date, job_id "
            "FROM ranked WHERE rownum = 1)"
        )

    def layers(self) -> list[str]:
        return [
            self.src(), self.rej_datatype(), self.stg(), self.ranked(), self.rej_duplicate(), self.dw(),
        ]


def _types(columns, labels=_LABELS) -> list[str]:
    cells = " UNION ALL ".join(
        f"SELECT _src_row, {i} AS pos, '{c}' AS col, {c} AS value FROM tmp" for i, c in enumerate(columns)
    )
    return [
        f"cells AS ({cells})",
        f"labelled AS (SELECT *, {_label('value', labels)} AS label FROM cells)",
        "ballots AS (SELECT col, label, count(*) AS n, min(_src_row) AS first_row "
        "FROM labelled WHERE label IS NOT NULL GROUP BY col, label)",
        "winners AS (SELECT col, label FROM (SELECT *, row_number() OVER (PARTITION BY col "
        "ORDER BY n DESC, first_row) AS place FROM ballots) WHERE place = 1)",
        "types AS (SELECT l.col, CAST(l.pos AS INTEGER) AS pos, coalesce(w.label, 'STRING') AS inferred, "
        "count(*) FILTER (label_of = 'DATE') AS n_date, count(*) FILTER (label_of = 'INT64') AS n_int64, "
        "count(*) FILTER (label_of = 'FLOAT') AS n_float, count(*) FILTER (label_of = 'STRING') AS n_string "
        "FROM (SELECT col, pos, label AS label_of FROM labelled) l LEFT JOIN winners w ON w.col = l.col "
        "GROUP BY l.col, l.pos, w.label)",
    ]


def _sheet_body(feed: str) -> str:
    """Sheet rows below the header."""
    table, key, _, cells = fx.SHEETS[feed]
    columns = ", ".join(f"{c} AS c{i}" for i, c in enumerate(cells))
    return f"SELECT {key} + {fx.SHEET_START[feed] + 1} AS _src_row, {columns} FROM {table}"


def _sheet_text(feed: str) -> str:
    _, _, header, cells = fx.SHEETS[feed]
    names = [f"c{i}" for i in range(len(cells))]
    return (
        f"SELECT '{feed}' AS feed, CAST({fx.SHEET_START[feed]} AS BIGINT) AS _src_row, {len(cells)} AS n_cells, "
        f"'{'|'.join(header)}' AS cells "
        f"UNION ALL SELECT '{feed}', _src_row, {len(cells)}, {_row(names)} FROM ({_sheet_body(feed)})"
    )


def _sheet_tmp(feed: str, columns: Iterable[str]) -> str:
    cells = ", ".join(f"nullif({_clean(f'c{i}')}, '') AS {c}" for i, c in enumerate(columns))
    return f"SELECT _src_row, {cells} FROM ({_sheet_body(feed)})"


def _sheet_dw(feed: str, columns, numeric, keys, date=()) -> str:
    layers = _Feed(columns, date, numeric, keys)
    values = " || '|' || ".join(f"coalesce({layers.text(c)}, '')" for c in columns)
    parts = [f"tmp AS ({_sheet_tmp(feed, columns)})", layers.src(), layers.stg(), layers.ranked(), layers.dw()]
    return "(" + _with(parts, f"SELECT '{feed}' AS feed, {values} AS dw_row, job_id FROM dw") + ")"


def _schema(rules: dict[str, str], columns: Iterable[str]) -> str:
    """Type groups of one run's columns."""
    groups = (
        "SELECT col, pos, CASE WHEN inferred = 'DATE' THEN 'date' WHEN inferred IN ('INT64', 'FLOAT') "
        "THEN 'numeric' END AS grp FROM types"
    )
    return "(" + _with([_fixture("tmp", rules, "orders"), *_types(columns)], groups) + ")"


_CHANGES = """
SELECT 'purchases' AS feed, 'run_2' AS job_id, DATE '2024-01-06' AS job_date, change, col, old_col, pos, old_pos, grp,
  old_grp FROM (
  SELECT 'retyped' AS change, n.col, o.col AS old_col, n.pos, o.pos AS old_pos, n.grp, o.grp AS old_grp
  FROM now n JOIN old o ON o.col = n.col WHERE n.grp IS DISTINCT FROM o.grp
  UNION ALL
  SELECT 'moved', n.col, o.col, n.pos, o.pos, n.grp, o.grp FROM now n JOIN old o ON o.col = n.col WHERE n.pos <> o.pos
  UNION ALL
  SELECT 'renamed', n.col, o.col, n.pos, o.pos, n.grp, o.grp FROM fresh n JOIN gone o
  ON o.pos = n.pos AND o.grp IS NOT DISTINCT FROM n.grp
  UNION ALL
  SELECT 'new', n.col, NULL, n.pos, NULL, n.grp, NULL FROM fresh n
  WHERE NOT EXISTS (SELECT 1 FROM gone o WHERE o.pos = n.pos AND o.grp IS NOT DISTINCT FROM n.grp)
  UNION ALL
  SELECT 'lost', NULL, o.col, NULL, o.pos, NULL, o.grp FROM gone o
  WHERE NOT EXISTS (SELECT 1 FROM fresh n WHERE o.pos = n.pos AND o.grp IS NOT DISTINCT FROM n.grp)
)
"""


def _reconcile(feed: _Feed) -> str:
    counts = {
        "tmp": "SELECT count(*) FROM tmp",
        "src": "SELECT count(*) FROM src",
        "rej_datatype": "SELECT count(*) FROM rej_datatype",
        "leaked": f"SELECT count(*) FROM tmp WHERE NOT ({feed.accepted}) AND NOT ({feed.rejected})",
        "dw": "SELECT count(*) FROM dw",
        "rej_duplicate": "SELECT count(*) FROM rej_duplicate",
    }
    rows = " UNION ALL ".join(f"SELECT '{k}' AS layer, ({q}) AS n_rows" for k, q in counts.items())
    return _with([_PURCHASES, *feed.layers()], rows)


_PURCHASES = _fixture("tmp", fx.PURCHASES, "orders")
_NUMERIC = ("branch_id", "amount", "discount")
_INFERRED = _Feed(fx.COLUMNS, ("transaction_date",), _NUMERIC, fx.KEYS)
_FORCED = _Feed(fx.COLUMNS, (), _NUMERIC, fx.KEYS)
_ALIGNED = _Feed(fx.COLUMNS, ("transaction_date",), _NUMERIC, fx.KEYS, aligned=True)


def statements() -> dict[str, str]:
    headers = _fixture("headers", fx.HEADERS, "part")
    landing = _fixture("landing", fx.LANDING, "documents")
    null_keys = _fixture("tmp", fx.NULL_KEYS, "orders")
    orders_cells = _fixture("ragged", fx.RAGGED, "orders")
    feeds = _fixture("feeds", fx.FEEDS, "events")
    keys = ", ".join(fx.KEYS)
    columns = ", ".join(fx.COLUMNS)
    padded = " || '|' || ".join(f"coalesce(cells[{i + 1}], '')" for i in range(fx.RAGGED_WIDTH))
    control = (
        "control AS (SELECT event_type AS job_name, upper("
        f"{fx.CONTROL_STATUS}) AS status FROM (SELECT DISTINCT event_type FROM events "
        f"WHERE event_type <> '{fx.UNKNOWN_JOB}'))"
    )
    feed_votes = (
        "labelled AS (SELECT feed, _src_row, pos, "
        f"{_label('value')} AS label FROM (SELECT feed, _src_row, unnest(range(len(cells))) AS pos, "
        "unnest(cells) AS value FROM feeds))"
    )
    catalogue = ("name", "brand", "size", "price", "price_1")
    key_list = "list_transform(string_split(primary_keys, ','), lambda k: trim(k))"
    rejects = (
        "SELECT * FROM rej_datatype UNION ALL SELECT * FROM rej_duplicate"
    )
    by_column = " UNION ALL ".join(
        f"SELECT rej_reason, job_id, job_date, '{c}' AS column_name FROM "
        f"(SELECT 'DATATYPE MISMATCH' AS rej_reason, {_AUDIT} FROM tmp WHERE {test})"
        for c, test in _INFERRED.failures.items()
    )
    return {
        "ingest_sheet": f"{_sheet_text('purchases')} UNION ALL {_sheet_text('suppliers')}",
        "header_sanitize": _with([headers], f"SELECT feed, pos, header, {_header('header')} AS clean FROM headers"),
        "header_dedup": _with(
            [
                headers,
                f"cleaned AS (SELECT feed, pos, {_header('header')} AS clean FROM headers)",
                "numbered AS (SELECT *, row_number() OVER (PARTITION BY feed, clean ORDER BY pos) - 1 AS nth "
                "FROM cleaned)",
            ],
            "SELECT feed, pos, clean, CASE WHEN nth = 0 THEN clean ELSE clean || '_' || nth END AS name "
            "FROM numbered",
        ),
        "row_pad": _with(
            [orders_cells],
            f"SELECT _src_row, {padded} AS cells, len(cells) > {fx.RAGGED_WIDTH} AS too_long FROM ragged",
        ),
        "cell_clean": _with(
            [_fixture("raw", fx.CELLS, "documents")], f"SELECT doc_id, {_clean('cell')} AS cell FROM raw"
        ),
        "landing_roundtrip": _with(
            [landing],
            "SELECT " + ", ".join(f"nullif({_clean(c)}, '') AS {c}" for c in fx.LANDING) + " FROM landing",
        ),
        "load_tmp": _sheet_tmp("catalogue", catalogue),
        "blank_to_null": _with([_PURCHASES], f"SELECT _src_row, {columns} FROM tmp"),
        "classify_cells": _with([_PURCHASES, *_types(fx.COLUMNS)], "SELECT _src_row, col, value, label FROM labelled"),
        "infer_types": _with([_PURCHASES, *_types(fx.COLUMNS)], "SELECT * FROM types"),
        "infer_types_merged": _with([_PURCHASES, *_types(fx.COLUMNS)], "SELECT * FROM types"),
        "schema_changes": _with(
            [
                f"old AS {_schema(fx.PURCHASES, fx.COLUMNS)}",
                f"now AS {_schema(fx.DRIFTED, fx.DRIFTED_COLUMNS)}",
                "fresh AS (SELECT * FROM now WHERE col NOT IN (SELECT col FROM old))",
                "gone AS (SELECT * FROM old WHERE col NOT IN (SELECT col FROM now))",
            ],
            _CHANGES,
        ),
        "routed_rows": _with(
            [_PURCHASES],
            f"SELECT CASE WHEN {_INFERRED.accepted} THEN 'src' WHEN {_INFERRED.rejected} THEN 'rej' ELSE 'leaked' END "
            f"AS _route, _src_row, {', '.join(f'{_strip(c)} AS {c}' for c in fx.COLUMNS)}, {_row(fx.COLUMNS)} AS row, "
            f"CASE WHEN NOT ({_INFERRED.accepted}) AND ({_INFERRED.rejected}) THEN 'DATATYPE MISMATCH' END AS rej_reason, "
            f"CASE WHEN NOT ({_INFERRED.accepted}) AND ({_INFERRED.rejected}) THEN {_INFERRED.detail} END AS rej_detail "
            "FROM tmp",
        ),
        "schema_groups": _with(
            [_PURCHASES, *_types(fx.COLUMNS)],
            "SELECT col, pos, inferred, CASE inferred WHEN 'DATE' THEN 'date' WHEN 'INT64' THEN 'numeric' "
            "WHEN 'FLOAT' THEN 'numeric' END AS grp FROM types",
        ),
        "infer_types_multi": _with(
            [
                feeds,
                feed_votes,
                "ballots AS (SELECT feed, pos, label, count(*) AS n, min(_src_row) AS first_row FROM labelled "
                "WHERE label IS NOT NULL GROUP BY ALL)",
                "winners AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feed, pos "
                "ORDER BY n DESC, first_row) AS place FROM ballots) WHERE place = 1)",
                "counts AS (SELECT feed, pos, count(*) FILTER (label = 'DATE') AS n_date, "
                "count(*) FILTER (label = 'INT64') AS n_int64, count(*) FILTER (label = 'FLOAT') AS n_float, "
                "count(*) FILTER (label = 'STRING') AS n_string FROM labelled GROUP BY feed, pos)",
            ],
            "SELECT c.feed, CAST(c.pos AS INTEGER) AS pos, coalesce(w.label, 'STRING') AS inferred, n_date, "
            "n_int64, n_float, n_string FROM counts c LEFT JOIN winners w ON w.feed = c.feed AND w.pos = c.pos",
        ),
        "src_project": _with(
            [landing], "SELECT " + ", ".join(f"{_strip(c)} AS {c}" for c in fx.LANDING) + " FROM landing"
        ),
        "audit_columns": f"SELECT event_id, ts + INTERVAL 7 HOUR AS local_time, {_AUDIT} FROM events",
        "row_text": _with([_PURCHASES], f"SELECT _src_row, {_row(fx.COLUMNS)} AS row FROM tmp"),
        "valid_date": _with(
            [_PURCHASES], f"SELECT _src_row, transaction_date, {_is_date('transaction_date')} AS ok FROM tmp"
        ),
        "valid_numeric": _with(
            [_PURCHASES],
            "SELECT _src_row, " + ", ".join(f"{_is_number(c, _ACCEPT)} AS {c}" for c in _NUMERIC) + " FROM tmp",
        ),
        "reject_numeric": _with(
            [_PURCHASES],
            "SELECT _src_row, " + ", ".join(f"NOT {_is_number(c, _REJECT)} AS {c}" for c in _NUMERIC) + " FROM tmp",
        ),
        "route_rows": _with(
            [_PURCHASES],
            f"SELECT _src_row, {_INFERRED.accepted} AS accepted, {_INFERRED.rejected} AS rejected FROM tmp",
        ),
        "ext_to_src": _with([_PURCHASES, _INFERRED.src()], "SELECT * FROM src"),
        "reject_detail": _with([_PURCHASES], f"SELECT _src_row, {_INFERRED.detail} AS rej_detail FROM tmp"),
        "rej_datatype": _with([_PURCHASES, _INFERRED.rej_datatype()], "SELECT * FROM rej_datatype"),
        "rej_datatype_empty": _with(
            [_PURCHASES, _Feed(fx.COLUMNS, (), (), fx.KEYS).rej_datatype()], "SELECT * FROM rej_datatype"
        ),
        "run_slice": _with(
            [_fixture("runs", fx.RUN_ROWS, "orders")],
            f"SELECT _src_row, {columns}, job_date, job_id FROM runs "
            "WHERE job_id = 'run_f' AND job_date = DATE '2024-01-05'",
        ),
        "cast_date": _with(
            [_PURCHASES],
            f"SELECT _src_row, transaction_date, {_date_value('transaction_date')} AS value FROM tmp",
        ),
        "cast_numeric": _with([_PURCHASES], f"SELECT _src_row, amount, {_number_value('amount')} AS value FROM tmp"),
        "cast_percent": _with(
            [_PURCHASES], f"SELECT _src_row, discount, {_number_value('discount')} AS value FROM tmp"
        ),
        "blank_string": _with(
            [headers], "SELECT feed, pos, CASE WHEN header <> '' THEN header END AS value FROM headers"
        ),
        "src_to_stg": _with([_PURCHASES, _INFERRED.src(), _INFERRED.stg()], "SELECT * FROM stg"),
        "dedup_rank": _with(
            [_PURCHASES, _FORCED.src(), _FORCED.stg(), _FORCED.ranked()],
            f"SELECT _src_row, {keys}, rownum FROM ranked",
        ),
        "dedup_rank_blocked": _with(
            [_PURCHASES, _FORCED.src(), _FORCED.stg(), _FORCED.ranked()],
            f"SELECT _src_row, {keys}, rownum FROM ranked",
        ),
        "dedup_null_keys": _with(
            [null_keys, _FORCED.src(), _FORCED.stg(), _FORCED.ranked()],
            f"SELECT _src_row, {keys}, rownum FROM ranked",
        ),
        "duplicate_detail": _with(
            [_PURCHASES, _FORCED.src(), _FORCED.stg()],
            f"SELECT _src_row, {_FORCED.key_detail} AS rej_detail FROM stg",
        ),
        "rej_duplicate": _with([_PURCHASES, *_FORCED.layers()], "SELECT * FROM rej_duplicate"),
        "rej_duplicate_null_keys": _with([null_keys, *_FORCED.layers()], "SELECT * FROM rej_duplicate"),
        "stg_to_dw": _with([_PURCHASES, *_FORCED.layers()], "SELECT * FROM dw"),
        "stg_to_dw_lookup": _with([_PURCHASES, *_FORCED.layers()], "SELECT * FROM dw"),
        "sink_overwrite": _with([_PURCHASES, _INFERRED.src(), _INFERRED.stg()], "SELECT * FROM stg"),
        "rej_all": _with([_PURCHASES, *_FORCED.layers()], rejects),
        "rej_all_retried": _with([_PURCHASES, *_FORCED.layers()], rejects),
        "gate_feeds": _with(
            [control],
            "SELECT event_id, event_type AS feed FROM events "
            "WHERE event_type IN (SELECT job_name FROM control WHERE status = 'OK')",
        ),
        "blocked_feeds": _with([control], "SELECT feed, status FROM (SELECT DISTINCT event_type AS feed FROM events) "
            "LEFT JOIN control ON job_name = feed WHERE coalesce(status, '') <> 'OK'"),
        "parse_key_list": _with(
            [_fixture("control", fx.KEY_LISTS, "customer")],
            "SELECT job_name, CAST(CASE WHEN coalesce(primary_keys, '') = '' THEN 0 "
            f"ELSE len({key_list}) END AS INTEGER) AS n_keys, "
            "CASE WHEN coalesce(primary_keys, '') = '' THEN '' "
            f"ELSE array_to_string({key_list}, '|') END AS keys FROM control",
        ),
        "multi_feed_dw": " UNION ALL ".join(
            [
                _sheet_dw("purchases", fx.COLUMNS, _NUMERIC, fx.KEYS, ("transaction_date",)),
                _sheet_dw("catalogue", catalogue, ("size", "price", "price_1"), ("name", "brand")),
                _sheet_dw("site visits", ("user", "day", "kind"), ("user",), ("user", "day")),
            ]
        ),
        "purchases_dw": _with([_PURCHASES, *_INFERRED.layers()], "SELECT * FROM dw"),
        "purchases_rejects": _with([_PURCHASES, *_INFERRED.layers()], rejects),
        "reject_summary": _with(
            [
                _PURCHASES,
                *_INFERRED.layers(),
                f"causes AS (SELECT rej_reason, job_id, job_date, NULL AS column_name FROM ({rejects}) "
                f"UNION ALL {by_column})",
            ],
            "SELECT job_id, job_date, rej_reason, column_name, count(*) AS n_rows FROM causes GROUP BY ALL",
        ),
        "reconcile": _reconcile(_INFERRED),
        "load_counts": _reconcile(_INFERRED),
        "profile_sample": _with(
            [_PURCHASES, "digests AS (SELECT *, md5('42:' || CAST(_src_row AS VARCHAR)) AS digest FROM tmp)"],
            f"SELECT _src_row, {columns} FROM digests WHERE digest < '80000000' ORDER BY digest LIMIT 1000",
        ),
        "reconcile_forced": _reconcile(_FORCED),
        "aligned_types": _with([_PURCHASES, *_types(fx.COLUMNS, _ALIGNED_LABELS)], "SELECT * FROM types"),
        "aligned_dw": _with([_PURCHASES, *_ALIGNED.layers()], "SELECT * FROM dw"),
        "aligned_rejects": _with([_PURCHASES, _ALIGNED.rej_datatype()], "SELECT * FROM rej_datatype"),
        "aligned_reconcile": _reconcile(_ALIGNED),
    }
