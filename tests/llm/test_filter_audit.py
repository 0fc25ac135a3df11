"""The filter audit against a plain loop over all orders."""

import re
from collections import defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from counterfoil.llm import filter_audit

COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
PROSE = " ".join(f"word{i}" for i in range(130))
DOCS = [
    (1, PROSE, "en"),
    (2, PROSE, "en"),
    (2, PROSE, "en"),
    (3, PROSE, None),
    (None, PROSE, "en"),
    (None, PROSE, ""),
    (4, None, "de"),
    (5, "", "de"),
    (6, "SHOUT LOUD & often", "en"),
    (7, "the " * 300, "en"),
    (8, PROSE + " #tag", "fr"),
    (9, PROSE.upper(), "en"),
    (10, "a\tb\nc" * 90000, "en"),
    (0, "SHOUT LOUD & often", None),
    (0, "SHOUT LOUD & often", None),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (7, 1, 1), (None, 1, 1), (99, 1, 1), (6, None, 1), (0, 1, None)]


def plain(docs, labels):
    failing = defaultdict(list)
    for doc_id, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in docs),
        }
        mine = [l for l in labels if l[0] is not None and l[0] == doc_id]
        good, toxic = any(l[1] == 1 for l in mine), any(l[2] == 1 for l in mine)
        failing[part or ""].append(({f for f in fails if fails[f]}, good, toxic))
    rows = {}
    for part, cells in failing.items():
        total = defaultdict(int)
        for order in permutations("ABCDE"):
            left = list(range(len(cells)))
            for step, letter in enumerate(order, 1):
                gone = [i for i in left if letter in cells[i][0]]
                earlier = [i for i in range(len(cells)) if i not in left and letter in cells[i][0]]
                left = [i for i in left if letter not in cells[i][0]]
                total[letter] += len(gone)
                rows[part, "".join(order), step] = [
                    len(left), len(gone), len(earlier), sum(c[0] == {letter} for c in cells),
                    sum(cells[i][1] for i in gone), sum(cells[i][2] for i in gone),
                ]
        for (p, order, step), row in rows.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in rows.items()}


def test_audit_equals_loop(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, lang string")
    clashing = docs.select("*", F.lit("x").alias("part"), F.lit(1).alias("Mask"), F.lit(2).alias("n"), F.lit(3).alias("words"))
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("good", F.lit(0))
    got = filter_audit.filter_audit(clashing, labels).collect()
    want = plain(DOCS, LABELS)
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COLUMNS) for r in got} == want
    assert len(got) == len(want) == 4 * 600
    assert all(r["letter"] == r["filter_order"][r["step"] - 1] for r in got)


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(docs, labels).collect() == []


def test_audit_of_other_cells(spark):
    """Any letters; parts are only limited by what the tables hold."""
    cells = spark.range(4000).selectExpr("cast(id as string) part", "int(id % 4) mask", "2L n", "1L good", "0L toxic")
    rows = filter_audit.audit(cells, "XY")
    assert rows.count() == 4000 * 2 * 2
    one = {(r["filter_order"], r["step"]): r["removed"] for r in rows.filter("part = '3'").collect()}
    assert one == {("XY", 1): 2, ("XY", 2): 0, ("YX", 1): 2, ("YX", 2): 0}
    with pytest.raises(ValueError):
        filter_audit.audit(cells, "AA")
