"""Payments of the accounting sample: the same numbers from one shuffle of the lines."""

from __future__ import annotations

import random
import re
import uuid
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loanlens.plans.accounting_catalog import Books
from loanlens.sources.sample_accounting import AccountingSample

LINE = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, \
l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
ORDER = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


class Made(AccountingSample):
    def __init__(self, spark, tables):
        super().__init__(spark, "")
        self.tables_made = tables

    def raw(self, name):
        return self.tables_made[name]


@pytest.fixture
def made(spark):
    """Loans 1 to 9 and their lines. Loan 3 comes twice, loan 10 has lines only; some lines have no part or number."""
    dice, day = random.Random(5), datetime(2000, 1, 1)
    orders = [(k, k % 2, "O", 10.0, day, "1-URGENT") for k in [*range(1, 10), 3]]
    lines = [
        (dice.randint(1, 10), dice.choice([None, *range(40)]), i, dice.choice([None, 1, 2, 3, 9, 17]), 1.0, 2.0, 0.0, 0.0, "R", "F", day + timedelta(i))
        for i in range(300)
    ]
    tables = {
        "orders": spark.createDataFrame(orders, ORDER),
        "lineitem": spark.createDataFrame(lines, LINE),
        "customer": spark.createDataFrame([(0, 0), (1, 1)], "c_custkey bigint, c_nationkey bigint"),
    }
    return Made(spark, tables), lines


def expected_payments(lines):
    groups, numbers = defaultdict(list), []
    for row in lines:
        order, part, _, line = row[:4]
        if order == 10:
            continue
        bucket = None if part is None or line is None else line + 8 * (part % 8)
        groups[order, line, bucket].append(row)
    for (order, line, bucket), found in groups.items():
        for n, row in enumerate(sorted(found, key=lambda r: (r[1] is not None, r[1] or 0, r[2])), 1):
            number = None if bucket is None else order * 10_000_000 + n * 64 + bucket
            numbers.append((order, line, number, row))
    first = {}
    for order, line, number, _ in numbers:
        if number is not None:
            first[order, line] = min(number, first.get((order, line), number))
    for order, line, number, row in numbers:
        returned = row[1] is None or row[1] % 24 >= 12
        before = first.get((order, line - 1)) if line is not None and returned else None
        yield from [(order, number, before)] * (2 if order == 3 else 1)


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_numbers_and_references_by_brute_force(spark, made, broadcast):
    sample, lines = made
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        found = [tuple(r) for r in sample.ca_payment().select("Appl_No", "Pmt_Tran_No", "Refno").collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    wanted = list(expected_payments(lines))
    assert sorted(found, key=str) == sorted(wanted, key=str)
    assert any(r[2] is not None for r in wanted)


def test_lines_are_shuffled_once(spark, made):
    """Before: once for the numbers, again for the loans, and twice more for the payments referred to."""
    sample, _ = made
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sample.ca_payment()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    keys = re.findall(r"hashpartitioning\((.*?), \d+\)", plan)
    assert sum("l_orderkey" in k for k in keys) == 1
    assert not any("l_linenumber" in k or "line#" in k for k in keys)


def test_renewal_links_join_orders_as_read(spark, made):
    """The loans, twice as wide as the orders, are made after the join."""
    sample, _ = made
    joined = sample.loan_appl()._jdf.queryExecution().optimizedPlan().toString()
    above = joined[: joined.index("Join LeftOuter")]
    assert "Merch_Store_Id" in above and "Merch_Store_Id" not in joined[len(above) :]
    assert sample.loan_appl().filter(F.col("Ren_ApplNo").isNotNull()).select("Loan_Type").distinct().first()[0] == "R"


class KeptBooks(Books):
    """Stored books over made tables."""

    def __init__(self, spark, tables):
        super().__init__(spark, str(uuid.uuid4()))
        self.tables_made = tables

    def raw(self, name):
        return self.tables_made[name]

    def _file_state(self):
        return 0


def test_books_need_no_renewal_links(spark, made):
    """Before: the loans of the books were those with their previous order, found by windows and two more joins."""
    books = KeptBooks(spark, made[0].tables_made)
    loans = books.loan_appl(with_renewals=False)
    assert "Window" not in loans._jdf.queryExecution().optimizedPlan().toString()
    found, wanted = Counter(loans.collect()), Counter(books.loan_appl().drop("Ren_ApplNo").collect())
    assert found == wanted and max(r["Appl_No"] for r in found) == 9
    assert Counter(r["Appl_No"] for r in found.elements())[3] == 4
