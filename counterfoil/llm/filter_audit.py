"""What a set of text filters removes, alone and after one another, in every order.

A document fails a set of filters, its mask. Documents are counted per part and mask, at
most 32 cells a part with five filters. A recursive query starts with the empty order and
extends every prefix by each letter that it does not hold yet: it joins the cells of the
part, carries the bits of the filters applied so far, and each level emits the numbers of
that step. The documents are read once; the recursion sees cells only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.session import pin

# What separates words, and the characters of filter D.
BETWEEN_WORDS = r"[\x20\x09-\x0D]+"
MARKUP = r"[#$%&*|]"
#: Orders grow with the factorial of the number of filters.
MOST_FILTERS = 7

STEP = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def words(text: Column) -> Column:
    return F.filter(F.split(text, BETWEEN_WORDS), lambda word: word != "")


def standard_filters(text: Column, found: Column) -> dict[str, Column]:
    """Failure conditions of the filters that look at one text; ``found`` holds its words."""
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(found) < 100,
        "B": 100 * F.size(F.array_distinct(found)) < 80 * F.size(found),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike(MARKUP),
    }


def mask_cells(docs: DataFrame, labels: DataFrame, text: str = "text", part: str = "lang") -> tuple[DataFrame, str]:
    """(part, mask, n, good, toxic) of the documents and the letters of the filters, bit by bit.

    ``docs`` has doc_id, text and a column for the parts, ``labels`` doc_id, quality and toxic; other columns are not
    looked at. NULL texts are empty texts, NULL parts the part ''. The last filter, E, is failed by a document whose text
    a smaller doc_id has too: a NULL doc_id is neither smaller nor larger than any, rows that share the least doc_id all
    pass. A document is good or toxic if any label row of its doc_id says so.

    Equal texts meet as digests that are counted before they are shuffled, so a text that many documents share is
    as many rows as it has parts and labels.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole.alias("whole")
    ).withColumn("words", words(F.col("whole")))
    filters = standard_filters(F.col("whole"), F.col("words"))
    letters = "".join(filters) + "E"
    mask = sum((F.when(fails, 1 << bit).otherwise(0) for bit, fails in enumerate(filters.values())), F.lit(0))
    copies = rows.select(
        "doc_id", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("whole"), 256)).alias("digest")
    ).groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("copies"))
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    # Rows without doc_id have no label; a key of their own keeps them from one task.
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("no id "), F.hex("digest")))
    marked = copies.withColumn("key", key).join(
        marks.select(F.col("doc_id").cast("string").alias("key"), "good", "toxic"), "key", "left"
    )
    known = F.col("doc_id").isNotNull()
    texts = marked.groupBy(
        "digest", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    ).agg(
        F.sum("copies").alias("n"),
        F.coalesce(F.sum(F.when(known, F.col("copies"))), F.lit(0)).alias("known"),
        F.min(F.when(known, F.struct("doc_id", "copies"))).alias("least"),
    )
    least = texts.groupBy("digest").agg(F.min("least.doc_id").alias("first"))
    bit = 1 << len(filters)
    repeats = F.col("known") - F.when(F.col("least.doc_id") == F.col("first"), F.col("least.copies")).otherwise(0)
    cells = texts.join(least, "digest").select(
        "part", "good", "toxic",
        F.explode(
            F.array(
                F.struct(F.col("mask"), (F.col("n") - repeats).alias("n")),
                F.struct(F.col("mask").bitwiseOR(bit).alias("mask"), repeats.alias("n")),
            )
        ).alias("cell"),
    )
    return cells.groupBy("part", F.col("cell.mask").alias("mask")).agg(
        F.sum("cell.n").alias("n"),
        F.sum(F.col("cell.n") * F.col("good")).alias("good"),
        F.sum(F.col("cell.n") * F.col("toxic")).alias("toxic"),
    ), letters


PREFIXES = """
WITH RECURSIVE steps AS (
    SELECT part, '' AS prefix, '' AS letter, 0 AS step, 0 AS applied, {none}
    FROM {cells}
    UNION ALL
    SELECT part, concat(prefix, letter), letter, step, applied | bit,
           aggregate(cells, 0L, (s, c) -> s + if(c.mask & (applied | bit) = 0, c.n, 0L)),
           aggregate(cells, 0L, (s, c) -> s + if(c.mask & applied = 0 AND c.mask & bit <> 0, c.n, 0L)),
           aggregate(cells, 0L, (s, c) -> s + if(c.mask & applied <> 0 AND c.mask & bit <> 0, c.n, 0L)),
           aggregate(cells, 0L, (s, c) -> s + if(c.mask = bit, c.n, 0L)),
           aggregate(cells, 0L, (s, c) -> s + if(c.mask & applied = 0 AND c.mask & bit <> 0, c.good, 0L)),
           aggregate(cells, 0L, (s, c) -> s + if(c.mask & applied = 0 AND c.mask & bit <> 0, c.toxic, 0L))
    FROM (
        SELECT longer.part, prefix, step + 1 AS step, applied, cells, unused.letter, unused.bit
        FROM steps AS longer JOIN {cells} AS own ON longer.part = own.part
             LATERAL VIEW explode(filter({letters}, l -> applied & l.bit = 0)) AS unused
        WHERE step < {most})
)
SELECT part, prefix, letter, step, {measures} FROM steps WHERE step > 0
"""


def audit(cells: DataFrame, letters: str) -> DataFrame:
    """part, filter_order, step, letter, the numbers of the step, and shapley of its filter.

    ``cells`` is (part, mask, n, good, toxic); bit i of a mask stands for ``letters[i]``. One row per part, order of all
    letters and step, zeros included; no cells give no rows. Numbers of a prefix are worked out once for all
    orders that begin with it. shapley is what the filter removes, summed over all orders.
    """
    if not 0 < len(letters) <= MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"one to {MOST_FILTERS} different letters")
    spark = cells.sparkSession
    by_part = pin(
        cells.groupBy("part").agg(
            F.collect_list(F.struct("mask", *[F.col(c).cast("long").alias(c) for c in ("n", "good", "toxic")])).alias("cells")
        )
    )
    known = "array({})".format(", ".join(f"struct('{l}' AS letter, {1 << b} AS bit)" for b, l in enumerate(letters)))
    query = PREFIXES.replace("{letters}", known).replace("{most}", str(len(letters))).replace(
        "{measures}", ", ".join(STEP)
    ).replace("{none}", ", ".join(f"0L AS {name}" for name in STEP))
    # Rows of the recursion are the prefixes of every part: 326 a part for five letters, however many parts there are.
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        steps = pin(spark.sql(query, cells=by_part))
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)
    orders = steps.filter(F.col("step") == len(letters)).select("part", F.col("prefix").alias("filter_order"))
    prefixes = orders.select(
        "part", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step")
    ).withColumn("prefix", F.expr("substring(filter_order, 1, step)"))
    rows = pin(prefixes.join(steps, ["part", "prefix", "step"]).drop("prefix"))
    totals = rows.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return rows.join(totals, ["part", "letter"]).select("part", "filter_order", "step", "letter", *STEP, "shapley")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five standard filters over ``docs``; see ``mask_cells`` and ``audit``."""
    return audit(*mask_cells(docs, labels))
