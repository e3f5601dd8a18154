"""Codes in any case and with trailing blanks; amounts, counts and first loans beyond small sizes."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_status import AT, LOANS, PAYMENTS, STORE_ROWS, STORES, random_tables

from loanlens.functions.loan import METRIC_VALUE, cso_share, ratio
from loanlens.operators.status import classify
from loanlens.plans.fact import fact_batch


def untidy(code: str, n: int) -> str:
    return (code.lower() if n % 2 else code) + " " * (n % 3)


def test_codes_in_any_case_give_the_same_facts(spark):
    loans, pays = random_tables(4, loans=150)
    stores = spark.createDataFrame(STORE_ROWS, STORES)
    tidy = fact_batch(spark.createDataFrame(loans, LOANS), spark.createDataFrame(pays, PAYMENTS), stores, AT)
    rough_loans = [(*r[:6], untidy(r[6], r[0]), untidy(r[7], r[0] // 2), *r[8:]) for r in loans]
    rough_pays = [(r[0], r[1], untidy(r[2], i), r[3]) for i, r in enumerate(pays)]
    rough = fact_batch(spark.createDataFrame(rough_loans, LOANS), spark.createDataFrame(rough_pays, PAYMENTS), stores, AT)
    assert rows(rough) == rows(tidy)


def test_blank_status_is_not_granted(spark):
    loans, pays = random_tables(4, loans=40)
    loans = [(*r[:6], " ", *r[7:]) for r in loans]
    stores = spark.createDataFrame(STORE_ROWS, STORES)
    found = classify(spark.createDataFrame(loans, LOANS), spark.createDataFrame(pays, PAYMENTS), stores, AT, ["Active", "New"])
    assert found.count() == 0


def test_new_alone_equals_new_among_others(spark):
    loans, pays = random_tables(8)
    tables = spark.createDataFrame(loans, LOANS), spark.createDataFrame(pays, PAYMENTS), spark.createDataFrame(STORE_ROWS, STORES)
    alone = classify(*tables, AT, ["New"])
    among = classify(*tables, AT, ["New", "Paid_D"]).filter("Status = 'New'")
    assert rows(alone) == rows(among) and alone.count() > 0


@pytest.mark.parametrize(
    ("paid", "charge", "fee"),
    [("10", "30", "20000000"), ("200000000000", "300000000000", "7"), ("0.0100", "0.0300", "0.0450"), ("-5", "-3", "2"),
     ("-5", "10", "3.3333"), ("1", "8", "0.04"), ("99999999999999", "999999999999999", "99999999999999"), ("5", "0", "2")],
)
def test_fee_share_of_any_size(spark, paid, charge, fee):
    p, c, f = (Decimal(x) for x in (paid, charge, fee))
    got = spark.range(1).select(cso_share(*[F.lit(x).cast("decimal(19,4)") for x in (p, c, f)]).alias("s")).first().s
    exact = (p * f / c).quantize(Decimal("0.01"), ROUND_HALF_UP) if c else None
    wanted = Decimal(0)
    if p > 0:
        wanted = f if p >= c else exact
    elif p < 0:
        wanted = -f if p >= c else exact if c else Decimal(0)
    assert got == wanted


def test_metric_values_hold_large_counts(spark):
    row = spark.range(1).select(
        F.lit(10**14).cast(METRIC_VALUE).alias("n"),
        ratio(F.lit(10**14).cast(METRIC_VALUE), F.lit(3).cast(METRIC_VALUE)).alias("r"),
    ).first()
    assert row.n == 10**14 and row.r == Decimal("33333333333333.333")
