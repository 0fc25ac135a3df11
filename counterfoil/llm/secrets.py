"""Secret scans over a ledger of blobs: each text is scanned once per rule version.

Every version of every path is content-addressed by the SHA-256 of its text. The ledger
is a table with a row per blob, rule and rule version that has been scanned, and the
spans found. A scan takes the different blobs, drops the pairs of blob and rule version
that the ledger knows, scans the rest, appends, and joins findings back to all paths.

Everything is DataFrame functions. A pattern that is anchored where the last match ended
cuts a text into pieces, each a gap and a match; running sums of their lengths are
positions in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from counterfoil.session import pin

LEDGER = "blob_id string, rule string, version int, spans array<struct<start: bigint, end: bigint>>"
MARK = "[SECRET]"


@dataclass(frozen=True)
class Rule:
    """``least``: fewest characters of group ``group``. ``hint``: texts that do not match it are not searched."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    hint: str


# The base rules, then those that come on top.
# A hexadecimal or access run either is long enough from its first character on or nowhere,
# so its least length stands in the pattern; an assignment consumes text even if its value is short.
BASE_RULES = (
    Rule(
        "assign",
        1,
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
        r"(?i)passw|secret|token|api_?key",
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", 0, 18, "AKIA"),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16, r"[0-9a-f]{16}"),
)
MORE_RULES = (
    Rule("private_key", 1, r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----", 0, 27, "PRIVATE KEY-----"),
    Rule("bearer", 1, r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, "gh[pousr]_|xox[abprs]-"),
)
RULES = BASE_RULES + MORE_RULES


def _pieces(text: Column, rule: Rule) -> Column:
    """Array of (rule, n, length, matched, fits) of each gap with the match behind it."""
    cut = F.regexp_extract_all(text, F.lit(rf"(?s)\G.*?(?:{rule.pattern})"), F.lit(0))

    def piece(part: Column, n: Column) -> Column:
        matched = F.length(F.regexp_extract(part, rule.pattern, 0))
        value = F.length(F.regexp_extract(part, rule.pattern, rule.group)) if rule.group else matched
        return F.struct(
            F.lit(rule.kind).alias("rule"),
            n.alias("n"),
            F.length(part).cast("long").alias("length"),
            matched.cast("long").alias("matched"),
            (value >= rule.least).alias("fits"),
        )

    return F.transform(cut, piece)


def create_ledger(spark: SparkSession, path: str) -> str:
    """An empty ledger; fails if there is one."""
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(LEDGER)]
    spark.range(0).select(*nothing).write.mode("errorifexists").parquet(path)
    return path


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan the ``text`` of ``versions`` where the ledger does not know it; append what was found.

    Returns the ledger's rows of these rules (blobs of earlier scans included). NULL texts
    are empty texts. A run that dies has appended all of its rows or none; pairs that two
    runs scanned at once stand twice with equal spans, and one of them is returned.
    """
    spark = versions.sparkSession
    blobs = (
        versions.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .groupBy(blob_id("text"))
        .agg(F.first("text").alias("text"))
    )
    version = {r.kind: r.version for r in rules}
    pairs = [F.struct(F.lit(kind).alias("rule"), F.lit(number).alias("version")) for kind, number in version.items()]
    wanted = spark.range(1).select(F.inline(F.array(*pairs)))
    known = (
        spark.read.schema(LEDGER)
        .parquet(ledger)
        .join(wanted, ["rule", "version"], "left_semi")
        .groupBy("blob_id")
        .agg(F.collect_set("rule").alias("known"))
    )
    none = F.array().cast("array<string>")
    pending = F.array_except(F.array(*[F.lit(kind) for kind in version]), F.coalesce("known", none))
    unseen = blobs.join(known, "blob_id", "left").withColumn("pending", pending).filter(F.size("pending") > 0)
    nothing = F.array().cast("array<struct<rule:string,n:int,length:bigint,matched:bigint,fits:boolean>>")
    pieces = [
        F.when(F.array_contains("pending", r.kind) & F.col("text").rlike(r.hint), _pieces(F.col("text"), r)).otherwise(
            nothing
        )
        for r in rules
    ]
    # A blob without pieces keeps one row. All rows of a blob are where its text was: no further shuffle.
    rows = unseen.select("blob_id", "pending", F.explode_outer(F.concat(*pieces)).alias("piece"))
    end = F.sum("piece.length").over(Window.partitionBy("blob_id", "piece.rule").orderBy("piece.n"))
    span = F.struct(F.col("piece.rule").alias("rule"), (end - F.col("piece.matched")).alias("start"), end.alias("end"))
    found = (
        rows.select("blob_id", "pending", "piece.fits", span.alias("span"))
        .groupBy("blob_id")
        .agg(F.first("pending").alias("pending"), F.collect_list(F.when(F.col("fits"), F.col("span"))).alias("all"))
    )
    versions_of = F.create_map(*[F.lit(x) for pair in version.items() for x in pair])
    found.select("blob_id", F.explode("pending").alias("rule"), "all").select(
        "blob_id",
        "rule",
        versions_of[F.col("rule")].alias("version"),
        F.transform(
            F.filter("all", lambda x: x["rule"] == F.col("rule")),
            lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")),
        ).alias("spans"),
    ).write.mode("append").parquet(ledger)
    return spark.read.schema(LEDGER).parquet(ledger).join(wanted, ["rule", "version"], "left_semi")


def blob_id(text: str | Column) -> Column:
    """Content address; a NULL text is an empty text."""
    return F.sha2(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), 256).alias("blob_id")


def _spans(scanned: DataFrame) -> DataFrame:
    """(blob_id, rule, start, end), one row per span, also where a pair stands in the ledger twice."""
    return (
        scanned.filter(F.size("spans") > 0)
        .select("blob_id", "rule", F.explode("spans").alias("span"))
        .select("blob_id", "rule", "span.start", "span.end")
        .distinct()
    )


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["rule"], x["start"], x["end"])), ",")


def _number(kind: str) -> Column:
    return F.size(F.filter("base", lambda x: x["rule"] == kind)).cast("long").alias(f"n_{kind}")


def findings(versions: DataFrame, scanned: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Each row of ``versions`` without its text, with what its blob holds.

    n_<rule> for each base rule, ``base_sha256`` of the base spans, ``spans`` of all rules,
    ``n_spans``; spans are kind:start:end by start, then by the order of the rules. Only blobs
    with findings are joined; a blob that many paths share is one row of that side.
    """
    place = F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (r.kind, k)])
    base = [r.kind for r in BASE_RULES]
    per_blob = (
        _spans(scanned)
        .groupBy("blob_id")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("start", place[F.col("rule")].alias("place"), "rule", "end"))
            ).alias("all")
        )
        .select(
            "blob_id",
            F.filter("all", lambda x: x["rule"].isin(base)).alias("base"),
            "all",
        )
        .select(
            "blob_id",
            *[_number(kind) for kind in base],
            F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
            _joined(F.col("all")).alias("spans"),
            F.size("all").cast("long").alias("n_spans"),
        )
    )
    empty = {f"n_{k}": F.lit(0).cast("long") for k in base}
    empty |= {"base_sha256": F.sha2(F.lit(""), 256), "spans": F.lit(""), "n_spans": F.lit(0).cast("long")}
    taken = {"text", "blob_id", *empty}
    kept = [f"`{c}`" for c in versions.columns if c.lower() not in taken]
    # Written first, so that nothing but the join happens where a blob of many paths is; Spark then splits it.
    return (
        versions.select(*kept, blob_id("text"))
        .join(pin(per_blob, rows=scanned.count()), "blob_id", "left")
        .select(*kept, "blob_id", *[F.coalesce(c, other).alias(c) for c, other in empty.items()])
    )


def redact(docs: DataFrame, scanned: DataFrame) -> DataFrame:
    """``docs`` with MARK in place of each run of overlapping spans; texts without findings stay as they are.

    NULL texts stay NULL. A column n_chars is set to the length of a changed text.
    """
    spans = _spans(scanned)
    inside = Window.partitionBy("blob_id").orderBy("start", "end", "rule")
    reached = F.max("end").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    runs = (
        spans.withColumn("new", F.coalesce((F.col("start") >= reached).cast("int"), F.lit(1)))
        .withColumn("run", F.sum("new").over(inside))
        .groupBy("blob_id", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("blob_id")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_runs"))
        .withColumnRenamed("blob_id", "_blob")
    )
    text, runs_of = F.col("row.text"), F.col("_runs")

    def begin(k: Column) -> Column:
        """Where the text before run k begins."""
        return F.when(k > 0, runs_of[k - 1]["end"]).otherwise(0)

    before = F.transform(
        "_runs", lambda x, k: text.substr((begin(k) + 1).cast("int"), (x["start"] - begin(k)).cast("int"))
    )
    rest = text.substr((F.element_at("_runs", -1)["end"] + 1).cast("int"), F.length(text))
    changed = F.concat(F.array_join(F.transform(before, lambda x: F.concat(x, F.lit(MARK))), ""), rest)
    found = runs_of.isNotNull()
    joined = (
        docs.select(F.struct("*").alias("row"), blob_id("text").alias("_blob"))
        .join(pin(runs, rows=scanned.count()), "_blob", "left")
        .withColumn("_text", F.when(found, changed).otherwise(text))
    )
    columns = {name: F.col(f"row.`{name}`") for name in docs.columns}
    columns["text"] = F.col("_text")
    for name in columns:
        if name.lower() == "n_chars":
            kind = docs.schema[name].dataType
            columns[name] = F.when(found, F.length("_text").cast(kind)).otherwise(columns[name])
    return joined.select(*[column.alias(name) for name, column in columns.items()])
