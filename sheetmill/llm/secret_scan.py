"""Secrets in texts: fixed patterns, and strings that look random.

Method: stretches of key-like characters go through a battery of randomness tests in their
inferred encoding: uniformity of the alphabet (chi-squared), runs about the middle, and serial
correlation. The smallest p-value decides, corrected for three tests. Random strings have uniform
p-values; how many there are is estimated per length class from the distinct strings, and the threshold of
each class keeps the expected share of others among the strings reported at the target. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheetmill.llm.common import text_or_empty, written

#: Kinds in their order, patterns, and least lengths.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LEAST = 12

#: What the battery looks at, and the alphabets it knows: name, pattern, symbols in order.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = (
    ("hex", "^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("HEX", "^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", _LOWER.upper() + "234567"),
    ("alnum", "^[A-Za-z0-9]+$", _DIGITS + _LOWER.upper() + _LOWER),
    ("base64url", "^[A-Za-z0-9_-]+$", _LOWER.upper() + _LOWER + _DIGITS + "-_"),
    ("base64", "", _LOWER.upper() + _LOWER + _DIGITS + "+/_-"),
)
LENGTH_CLASSES = (32, 48, 64)
BINS = 100


def _cut(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (gap, hit, value): the characters before each match, and the match; the rest of
    the text is a last gap without one. Null if nothing matches."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    return F.when(
        F.size(hits) > 0, F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value"))
    )


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, to about 2e-4."""
    z = F.least(F.greatest(z, F.lit(-8.0)), F.lit(8.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * F.pow(z, 3)))


def _alphabet(token: Column) -> Column:
    """The symbols of the first encoding that ``token`` fits."""
    found = F.lit(ALPHABETS[-1][2])
    for _, pattern, symbols in reversed(ALPHABETS[:-1]):
        found = F.when(token.rlike(pattern), F.lit(symbols)).otherwise(found)
    return found


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def with_randomness(coded: DataFrame) -> DataFrame:
    """Add ``p``: the p-value of (codes: places of the symbols, width: of the alphabet) being
    uniform and independent, corrected for three tests. Strings whose symbols are all on one
    side of the middle, or all the same, get 0."""
    codes, width, n = F.col("codes"), F.col("width"), F.size("codes").cast("double")
    middle = width / 2
    neighbours = (F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1))
    sums = coded.select(
        "*",
        n.alias("_n"),
        _total(
            F.transform(
                F.sequence(F.lit(0), width.cast("int") - 1),
                lambda v: F.pow(F.size(F.filter(codes, lambda x: x == v)).cast("double"), 2),
            )
        ).alias("_squares"),
        F.size(F.filter(codes, lambda x: x >= middle)).cast("double").alias("_high"),
        _total(
            F.zip_with(*neighbours, lambda a, b: ((a >= middle) != (b >= middle)).cast("double"))
        ).alias("_turns"),
        _total(F.transform(codes, lambda x: x.cast("double"))).alias("_sum"),
        _total(F.transform(codes, lambda x: x.cast("double") * x)).alias("_sum2"),
        _total(F.zip_with(*neighbours, lambda a, b: a.cast("double") * b)).alias("_lag"),
        (F.element_at(codes, 1) + F.element_at(codes, -1)).cast("double").alias("_ends"),
    )
    n, high = F.col("_n"), F.col("_high")
    low = n - high
    # Chi-squared by the cube-root normal approximation.
    free = width - 1
    chi = width / n * F.col("_squares") - n
    part = 2 / (9 * free)
    p_chi = _upper_tail((F.pow(chi / free, 1 / 3) - (1 - part)) / F.sqrt(part))
    # Runs above and below the middle.
    both = 2 * high * low
    spread = both * (both - n) / (n * n * (n - 1))
    z_runs = (F.col("_turns") + 1 - (both / n + 1)) / F.sqrt(spread)
    p_runs = F.when(spread > 0, 2 * _upper_tail(F.abs(z_runs))).otherwise(0.0)
    # Correlation of neighbours.
    mean = F.col("_sum") / n
    variance = F.col("_sum2") - n * mean * mean
    lagged = F.col("_lag") - mean * (2 * F.col("_sum") - F.col("_ends")) + (n - 1) * mean * mean
    z_lag = (lagged / variance + 1 / n) * F.sqrt(n)
    p_lag = F.when(variance > 1e-9, 2 * _upper_tail(F.abs(z_lag))).otherwise(0.0)
    least = F.least(p_chi, p_runs, p_lag, F.lit(1.0))
    return sums.withColumn("p", 1 - F.pow(1 - least, 3)).drop(
        *(c for c in sums.columns if c.startswith("_"))
    )


def thresholds(scored: DataFrame, target: float) -> DataFrame:
    """The least bin of ``p`` to report, by length class: (class, least).

    Random strings are spread evenly over p, so those above one half tell how many there are; the
    rest of a class above a threshold are false. That needs independent strings, so the copies of one
    string (``string``: its hash) count once. After that, at most ``BINS`` rows per class are handled.
    """
    counts = scored.select("class", "bin", "string").distinct().groupBy("class", "bin").agg(F.count("*").alias("n"))
    above = Window.partitionBy("class").orderBy(F.desc("bin"))
    everyone = Window.partitionBy("class")
    upper = F.sum(F.when(F.col("bin") >= BINS // 2, F.col("n")).otherwise(0)).over(everyone)
    table = counts.select("class", "bin", F.sum("n").over(above).alias("reported"), (2 * upper).alias("random"))
    false = 1 - F.col("random") * (1 - F.col("bin") / BINS) / F.col("reported")
    return table.where((F.col("bin") > 0) & (false <= target)).groupBy("class").agg(F.min("bin").alias("least"))


def find_secrets(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", false_share: float = 0.05
) -> DataFrame:
    """Find secrets in every text.

    Returns one row per input row: doc_id, found (array of (start, kind, end), by start, then by
    kind as in ``KINDS``; kind is its number there). Spans are code points, the end exclusive, and
    cover whole matches. Matches of a kind do not overlap; ``random`` ones may overlap others.

    ``assign`` matches whose value is shorter than 12 characters are dropped after matching, so
    they still hide what they cover. Null texts count as empty and hold nothing. Null ids and
    repeated rows are kept; an empty table gives no rows; further columns are not read.

    Texts are scanned once and not shuffled; matches are, by row. The threshold of ``random``
    comes from all distinct candidates, through a histogram of fixed size, and holds for every
    occurrence. Copies are combined before the candidates' hashes are shuffled.
    """
    text = text_or_empty(F.col(text_col))
    cut = written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("doc_id"),
            _cut(text, ASSIGN, 2).alias("assign"),
            _cut(text, ACCESS).alias("access"),
            _cut(text, HEX).alias("hex"),
            _cut(text, CANDIDATE).alias("random"),
        ),
        "matches",
    )
    parts = None
    for number, kind in enumerate(KINDS):
        one = cut.where(F.col(kind).isNotNull()).select(
            "row", F.lit(number).alias("kind"), F.posexplode(kind).alias("place", "m")
        )
        parts = one if parts is None else parts.unionByName(one)
    upto = Window.partitionBy("row", "kind").orderBy("place")
    end = F.sum(F.col("m.gap") + F.coalesce(F.length("m.hit"), F.lit(0))).over(upto)
    hits = (
        parts.withColumn("end", end.cast("int"))
        .where("m.hit is not null")
        .select(
            "row",
            "kind",
            (F.col("end") - F.length("m.hit")).alias("start"),
            "end",
            F.when(F.col("kind") == KINDS.index("random"), F.col("m.hit")).alias("token"),
            F.length("m.value").alias("length"),
        )
        .where((F.col("kind") != KINDS.index("assign")) | (F.col("length") >= ASSIGN_LEAST))
        .withColumn("alphabet", F.when(F.col("token").isNotNull(), _alphabet(F.col("token"))))
    )
    hits = written(hits, "hits")
    candidates = hits.where("token is not null")
    coded = written(
        candidates.select(
            "row",
            "kind",
            "start",
            "end",
            "length",
            F.xxhash64("token").alias("string"),
            F.length("alphabet").cast("double").alias("width"),
            F.transform(F.split("token", ""), lambda c: F.position(c, F.col("alphabet")) - 1).alias("codes"),
        ),
        "coded",
    )
    steps = sum(((F.col("length") >= bound).cast("int") for bound in LENGTH_CLASSES), F.lit(0))
    scored = written(
        with_randomness(coded).select(
            "row",
            "kind",
            "start",
            "end",
            "string",
            steps.alias("class"),
            F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin"),
        ),
        "scored",
    )
    bounds = F.broadcast(thresholds(scored, false_share))  # one row per length class
    random = scored.join(bounds, "class").where("bin >= least")
    columns = ["row", "kind", "start", "end"]
    spans = hits.where("token is null").select(columns).unionByName(random.select(columns))
    found = spans.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("found")
    )
    none = F.array().cast("array<struct<start: int, kind: int, end: int>>")
    return cut.select("row", "doc_id").join(found, "row", "left").select(
        "doc_id", F.coalesce("found", none).alias("found")
    )


def span_text(found: Column, *, base_only: bool = False) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    if base_only:
        found = F.filter(found, lambda s: s["kind"] < KINDS.index("random"))
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )
