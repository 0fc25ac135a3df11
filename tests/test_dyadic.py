"""Reports from blocks of days equal reports from the lines."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from counterfoil.model import LINE_CHANGE
from counterfoil.operators import changes as ch
from counterfoil.operators import dyadic, money
from counterfoil.session import pin
from tests.conftest import rows


def test_cover_is_exact_and_short():
    rng = random.Random(1)
    for _ in range(500):
        start = dt.date(1950, 1, 1) + dt.timedelta(rng.randrange(40_000))
        end = start + dt.timedelta(rng.randrange(-2, rng.choice([3, 400, 60_000])))
        days = sorted(d for level, block in dyadic.cover(start, end) for d in range(block << level, (block + 1) << level))
        first = (start - dt.date(1970, 1, 1)).days
        assert days == list(range(first, first + (end - start).days + 1))
        assert len(dyadic.cover(start, end)) <= 2 * dyadic.LEVELS
    assert dyadic.cover(dt.date(2024, 1, 2), dt.date(2024, 1, 1)) == []


RANGES = [
    (dt.date(2024, 1, 1), dt.date(2024, 1, 31)), (dt.date(2024, 1, 5), dt.date(2024, 1, 5)), (dt.date(2024, 2, 1), dt.date(2024, 2, 10)),
    (dt.date(1900, 1, 1), dt.date(2100, 1, 1)), (dt.date(2025, 1, 1), dt.date(2024, 1, 1)),
]


@pytest.mark.parametrize("seed", [3, 4])
def test_reports_after_changes(spark, priced_shop, seed):
    rng = random.Random(seed)
    pos = priced_shop.with_(products=priced_shop.products.withColumn("availableQuantity", F.lit(50)))
    stored = pin(dyadic.blocks(dyadic.day_sums(pos)))
    for turn in range(2):
        feed = [
            (rng.choice(["insert", "insert", "update", "delete"]), turn * 100 + n, rng.choice([10, 11, 12, 14, 15]),
             rng.choice([1, 2, 3, 5, 7]), rng.randrange(1, 4), None, None)
            for n in range(25)
        ]
        accepted, _ = ch.validate_changes(spark.createDataFrame(feed, LINE_CHANGE), pos.lines, pos.products, pos.orders)
        pos, _ = ch.apply_changes(pos, accepted)
        pos = pos.with_(lines=pin(pos.lines), orders=pin(pos.orders), products=pin(pos.products))
        stored = pin(dyadic.updated(stored, dyadic.changed_days(accepted, pos.orders)))
        for start, end in RANGES:
            assert rows(dyadic.sales_report(stored, pos.products, start, end)) == rows(money.sales_report(pos, start, end))
        for product in (2, 7, 8):
            want = money.sales_report(pos, *RANGES[3], product)
            assert rows(dyadic.sales_report(stored, pos.products, *RANGES[3], product)) == rows(want)


def test_a_report_reads_blocks_only(spark, priced_shop, tmp_path):
    dyadic.blocks(dyadic.day_sums(priced_shop)).write.partitionBy("level").parquet(f"{tmp_path}/blocks")
    stored = spark.read.parquet(f"{tmp_path}/blocks")
    report = dyadic.sales_report(stored, priced_shop.products, *RANGES[0], 2)
    files = stored.where(dyadic._within(*RANGES[1])).inputFiles()
    assert files and "unitPrice" not in report._jdf.queryExecution().optimizedPlan().toString()
    assert stored.where(dyadic._within(*RANGES[0])).where("product_id = 2").count() <= 2 * dyadic.LEVELS


def test_blocks_are_not_shuffled(spark, priced_shop):
    """Days of a product are brought together; what they are summed up to stays where it is, also after changes."""
    days = pin(dyadic.day_sums(priced_shop))
    for made in (dyadic.blocks(days), dyadic.updated(pin(dyadic.blocks(days)), days)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
        assert exchanges and not any("level#" in line or "block#" in line for line in exchanges)
