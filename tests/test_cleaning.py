"""Cleaning functions against plain Python on random texts."""

import datetime as dt
import random
import re
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from counterfoil.functions import cleaning


def texts(alphabet, seed, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(8))) for _ in range(n)] + [None, "", " ", "0"]


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    got = {r["i"]: r["v"] for r in df.select("i", function(F.col("t")).alias("v")).collect()}
    return [got[i] for i in range(len(values))]


def test_money(spark):
    def plain(text):
        stripped = re.sub(r'[$,"]', "", text or "")
        if not re.fullmatch(r"-?(\d+\.?\d*|\.\d+)", stripped):
            return None
        value = Decimal(stripped).quantize(Decimal("0.01"), ROUND_HALF_UP)
        return value if abs(value) < 10000 else None

    values = texts('$,".0123456789', 1)
    assert apply(spark, cleaning.money, values) == [plain(v) for v in values]


def test_whole_number_and_zip(spark):
    values = texts("0123456789-. x", 2)
    digits = lambda v: v is not None and re.fullmatch("[0-9]+", v) is not None
    assert apply(spark, cleaning.whole_number, values) == [int(v) if digits(v) else None for v in values]
    assert apply(spark, cleaning.zip_code, values) == [
        v.rjust(5, "0") if digits(v) and len(v) <= 5 else None for v in values
    ]


def test_dates(spark):
    rng = random.Random(3)
    parts = [(rng.randrange(0, 14), rng.randrange(0, 33), rng.randrange(1900, 2100)) for _ in range(300)]

    def plain(month, day, year):
        try:
            return dt.date(year, month, day)
        except ValueError:
            return None

    want = [plain(*p) for p in parts]
    for form in ("{0}/{1}/{2}", "{0:02}/{1:02}/{2}"):
        assert apply(spark, cleaning.us_date, [form.format(*p) for p in parts]) == want
    for form in ("{2}-{0}-{1}", "{2}-{0:02}-{1:02} 23:59:59", "{2}-{0}-{1} 1:2:3"):
        assert apply(spark, cleaning.day_of, [form.format(*p) for p in parts]) == want
    odd = ["0000-00-00", "", "Cancelled", None, "2024-01-05T10:00:00", "5 Jan 2024"]
    assert apply(spark, lambda c: cleaning.day_of(c, cleaning.CANCELLED), odd) == [None] * len(odd)
