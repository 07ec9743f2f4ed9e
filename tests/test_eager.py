"""Totals summed before the addresses are met, and ranges that cover a day's invoices."""

from __future__ import annotations

import random
import re
from datetime import date, datetime
from decimal import Decimal

import pytest

from salesmart.operators.intervals import covering_ranges, within
from salesmart.plans import dims, eager, fact, marts
from salesmart.sources import testdata
from salesmart.sources.calendar import Calendar, dim_tempo
from tests import edge
from tests.edge import rows
from tests.test_plans import NO_BROADCAST, plan_of, settings

CALENDAR = Calendar(date(2015, 1, 1), date(2026, 12, 31))


def from_fact(src, first=None, last=None):
    star = dims.Star(tempo=dim_tempo(src.spark, CALENDAR), localidade=dims.dim_localidade(src))
    sold = fact.sales_fact(src, star, first, last)
    return (marts.monthly_sales(sold, star.tempo),
            marts.locality_sales(sold, star.tempo, star.localidade),
            marts.revenue_by_state(sold, star.tempo, star.localidade))


def straight(src, first=None, last=None):
    tempo = dim_tempo(src.spark, CALENDAR)
    return (eager.monthly_sales(src, tempo, first, last), eager.locality_sales(src, tempo, first, last),
            eager.revenue_by_state(src, tempo))


@pytest.fixture(scope="module")
def many(spark):
    """A buyer with half of the invoices and many addresses, unknown buyers and products,
    invoices without lines, NULL amounts, sales outside the calendar."""
    draw = random.Random(3)
    invoices, lines, addresses = [], [], [(i, 1, draw.randrange(1, 5), f"{i:05d}") for i in range(60)]
    addresses += [(100 + i, draw.choice([2, 3, 5, 9]), draw.choice([1, 2, 3, 4, None, 77]),
                   f"{draw.randrange(6):05d}") for i in range(40)]
    for i in range(200):
        day = datetime(draw.choice([2013, 2024, 2025]), draw.randrange(1, 13), draw.randrange(1, 28), 5)
        invoices.append((i, day, draw.choice([1, 1, 1, 2, 3, 4, 5, 99, None]), 6))
        for _ in range(draw.randrange(0, 5)):
            price = draw.choice([None, Decimal("0.01"), Decimal(draw.randrange(1, 9999)) / 100])
            lines.append((i, draw.choice([1, 2, 3, 44]), draw.choice([None, 1, 7]), price,
                          draw.choice([None, Decimal("3.33")])))
    return edge.source(spark, nota_fiscal=invoices, item_nota_fiscal=lines, endereco=addresses)


def test_equals_the_fact(many, edge_source):
    for src in (many, edge_source):
        for mine, other in zip(straight(src), from_fact(src)):
            assert mine.columns == other.columns and mine.dtypes == other.dtypes
            assert rows(mine) == rows(other) and rows(mine)


def test_equals_the_fact_of_some_days(many):
    span = date(2024, 3, 1), date(2025, 2, 10)
    for mine, other in list(zip(straight(many, *span), from_fact(many, *span)))[:2]:
        assert rows(mine) == rows(other) and rows(mine)


def test_years(many):
    tempo = dim_tempo(many.spark, CALENDAR)
    assert rows(eager.years_with_sales(many, tempo)) == rows(from_fact(many)[0].select("ano").distinct())


def _above(plan: str, line: int) -> list[str]:
    """The operators between a line of a plan tree and its root."""
    lines, out = plan.splitlines(), []
    depth = len(re.match(r"[\s:+\-|]*", lines[line]).group())
    for text in reversed(lines[:line]):
        here = len(re.match(r"[\s:+\-|]*", text).group())
        if here < depth:
            out.append(text)
            depth = here
    return out


@pytest.mark.parametrize("which", ["month", "place"])
def test_sums_come_before_the_addresses(spark, which):
    source = testdata.sales_source(spark, "/root/testdata/sf0.001")
    tempo = dim_tempo(spark, testdata.SHORT_CALENDAR)
    with settings(spark, **NO_BROADCAST):
        plan = plan_of((eager.monthly_sales if which == "month" else eager.locality_sales)(source, tempo), "simple")
    lines = plan.splitlines()
    sums = [i for i, text in enumerate(lines)
            if re.search(r"HashAggregate\(keys=\[ano#\d+(, mes#\d+)?, id_cliente#\d+L?\]", text)]
    met = [i for i, text in enumerate(lines) if re.search(r"Join .*\[id_cliente#\d+L?\], \[id_cliente#", text)]
    assert met and sums and met[0] < min(sums)
    # From the join with the addresses up there are only sums; the lines lie below it.
    above = _above(plan, min(sums))
    assert any("Join" in text for text in above)
    assert not any("item" in text or "l_orderkey" in text for text in above)
    # No locality is keyed: nothing is numbered, so nothing is range-sorted.
    assert "sk_localidade" not in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("most", [1, 2, 3, 16])
def test_ranges_cover_every_number_and_leave_the_widest_gaps(spark, most):
    numbers = [*range(1000, 1100), *range(5000, 5010), 900_000_000_000, 7, None]
    frame = spark.createDataFrame([(n,) for n in numbers], "id long")
    ranges = covering_ranges(frame, "id", most, buckets=1 << 40 if most == 3 else 4096)
    assert len(ranges) <= most
    assert frame.where(within("id", ranges)).count() == len(numbers) - 1
    if most > 1:
        assert ranges[-1] == (900_000_000_000, 900_000_000_000) and ranges[-2][1] == 5009
    assert covering_ranges(frame.where("id is null"), "id") == []
    assert frame.where(within("id", [])).count() == 0


def test_one_back_dated_invoice_does_not_read_the_whole_table(spark, edge_source, tmp_path):
    """The day's invoices are 5,000 numbers in a row and one from the beginning."""
    lines = spark.range(0, 200_000).selectExpr(
        "id AS id_nota_fiscal", "1L AS id_produto", "1L AS quantidade",
        "cast(1 AS decimal(18,2)) AS valor_unitario", "cast(1 AS decimal(18,2)) AS valor_venda_real")
    lines.repartitionByRange(40, "id_nota_fiscal").write.parquet(str(tmp_path / "lines"))
    stored = spark.read.parquet(str(tmp_path / "lines"))
    day = [*range(190_000, 195_000), 12]
    src = edge.source(spark, item_nota_fiscal=[])
    src.item_nota_fiscal = stored
    headers = spark.createDataFrame([(i,) for i in day], "id_nota long")
    found = fact.lines_of(src, headers)
    assert found.count() < 2 * len(day)
    assert found.join(headers, "id_nota", "left_semi").count() == len(day)
    assert re.search(r"PushedFilters: \[.*Or\(", plan_of(found))
