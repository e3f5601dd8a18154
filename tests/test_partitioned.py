"""Stored tables changed partition by partition: what is touched, what is left alone, and what a run leaves behind."""

from __future__ import annotations

import random
from datetime import date, datetime
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.functions.dates import AsOf
from loanlens.operators.partitioned import PartitionedTable, merge
from loanlens.operators.status import FACT_COLUMNS
from loanlens.plans.fact import fact_table, load_facts, store_changes, store_run

SCHEMA = T.StructType(
    [T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("s", T.StringType()), T.StructField("m", T.DateType())]
)
MAY, JUNE = date(2001, 5, 1), date(2001, 6, 1)
FIRST = [(1, "a", "Charged off", MAY), (2, "b", "Due", MAY), (3, "c", "Due", JUNE), (4, "d", "New", JUNE), (5, "e", "Due", None), (None, "f", "New", MAY)]


def files(path) -> set[str]:
    return {str(p.relative_to(path)) for p in Path(path).rglob("*.parquet")}


@pytest.fixture
def table(spark, tmp_path):
    own = PartitionedTable(spark, str(tmp_path / "t"), SCHEMA, ("s", "m"))
    own.create(spark.createDataFrame(FIRST, SCHEMA))
    return own


def test_a_row_moves_to_another_partition_and_an_emptied_one_goes(spark, table):
    before = files(table.path)
    batch = spark.createDataFrame([(1, "A", "Charged off", JUNE), (4, "D", "New", JUNE)], SCHEMA)
    touched = merge(table, batch, ["k", "s"])
    assert touched == {("Charged off", JUNE), ("Charged off", MAY), ("New", JUNE)}
    assert rows(table.read()) == rows(spark.createDataFrame([(1, "A", "Charged off", JUNE), *FIRST[1:3], (4, "D", "New", JUNE), *FIRST[4:]], SCHEMA))
    kept = {f for f in before if "s=Due" in f or ("s=New" in f and "m=2001-05-01" in f)}
    assert kept and kept <= files(table.path)
    assert ("Charged off", MAY) not in table.partitions()
    assert not any("s=Charged off" in f.replace("%20", " ") and "2001-05-01" in f for f in files(table.path))
    # Once more: the same rows, and the rest still untouched.
    again = rows(table.read())
    merge(table, batch, ["k", "s"])
    assert rows(table.read()) == again and kept <= files(table.path)


def test_windows_and_removed_keys(spark, table):
    gone = spark.createDataFrame([(5,), (None,), (77,)], "k long")
    batch = spark.createDataFrame([(9, "n", "Due", None)], SCHEMA)
    merge(table, batch, ["k", "s"], opened={("Due", JUNE), ("Due", date(1999, 1, 1))}, gone=F.lit(True), removed=(gone, ["k"]))
    assert rows(table.read(), "k") == [(1,), (2,), (4,), (9,)]


def test_only_chosen_partitions_are_read(spark, table):
    plan = table.within({("Due", MAY), ("Due", JUNE)})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "Due" in plan.split("PartitionFilters")[1]
    assert {r[2] for r in table.within({("Due", MAY), ("Due", None)}).collect()} == {"Due"}
    assert table.within(set()).count() == 0
    assert len(table.within({("Due", MAY)}).inputFiles()) == len(table.read().inputFiles())  # listed, not read
    read = table.within({("Due", MAY)}).select(F.input_file_name()).distinct().count()
    assert read == 1


def test_rows_of_other_partitions_are_refused(spark, table):
    before = rows(table.read())
    with pytest.raises(ValueError, match="not replaced"):
        table.replace({("Due", MAY)}, spark.createDataFrame([(1, "x", "New", MAY)], SCHEMA))
    assert rows(table.read()) == before


# -- the fact table --------------------------------------------------------------------------

AT = AsOf(date(2001, 6, 15), 3)
RAN, LATER = datetime(2001, 6, 15, 1), datetime(2001, 6, 15, 2)
LOANS = (
    "Appl_No bigint, Merch_Store_Id string, Cust_SSN string, Origin_Date date, Req_Due_Date date, Loan_Status string, "
    "Loan_Type string, Req_Loan_Amt decimal(12,2), Fin_Charge decimal(12,2), LastPmtDate date, Last_Modified date, Ren_ApplNo bigint"
)
PAYMENTS = "Appl_No bigint, Pmt_Date date, Pmt_Type string, Principle_Paid decimal(12,2)"


def loan(rng: random.Random, number: int) -> tuple:
    def day(low: int, high: int) -> date:
        return date.fromordinal(date(2001, 1, 1).toordinal() + rng.randrange(low, high))

    start = day(0, 160)
    return (
        number, rng.choice("zmq"), f"c{rng.randrange(25)}", start, day(20, 190), rng.choice("NODPRCBVDO"), rng.choice("SSSR"),
        rng.choice([100, 500]), rng.choice([10, 30]), rng.choice([day(30, 170), None]), day(30, 170),
        rng.choice([None, None, rng.randrange(1, 120)]),
    )


def payments(rng: random.Random, number: int) -> list[tuple]:
    return [
        (number, date.fromordinal(date(2001, 2, 1).toordinal() + rng.randrange(130)), rng.choice("NPSX"), rng.choice([0, 5]))
        for _ in range(rng.choice([0, 0, 1, 2]))
    ]


def money(rows_: list[tuple], places: tuple[int, ...]) -> list[tuple]:
    from decimal import Decimal

    return [tuple(Decimal(x) if i in places else x for i, x in enumerate(r)) for r in rows_]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_changes_give_what_a_whole_run_gives(spark, tmp_path, seed):
    rng = random.Random(seed)
    stores = spark.createDataFrame([("z", "Zip"), ("m", "Mini Money"), ("q", None)], "Merchant_Store_Id string, Product string")
    before = {n: loan(rng, n) for n in range(1, 120)}
    paid = {n: payments(rng, n) for n in before}
    after, paid_after = dict(before), dict(paid)
    for n in rng.sample(range(1, 135), 9):
        after[n] = loan(rng, n)  # changed (its customer, too) or new
    after.pop(rng.randrange(1, 120), None)
    for n in rng.sample(range(1, 120), 4):
        paid_after[n] = payments(rng, n)
    loans = [spark.createDataFrame(money(list(t.values()), (7, 8)), LOANS) for t in (before, after)]
    pays = [spark.createDataFrame(money([p for v in t.values() for p in v], (3,)), PAYMENTS) for t in (paid, paid_after)]
    changed = {n for n in {*before, *after} if before.get(n) != after.get(n) or paid.get(n) != paid_after.get(n)}
    images = [t[n] for t in (before, after) for n in changed if n in t]

    table = fact_table(spark, str(tmp_path / "facts"), loans[0])
    store_run(table, loans[0], pays[0], stores, AT, RAN, first=True)
    old = spark.createDataFrame(table.read().collect(), table.schema)
    files_before = files(table.path)
    expected = rows(load_facts(loans[1], pays[1], stores, AT, old.select(*FACT_COLUMNS)), *FACT_COLUMNS)

    touched = store_changes(table, loans[1], pays[1], stores, AT, LATER, spark.createDataFrame(money(images, (7, 8)), LOANS))
    assert rows(table.read(), *FACT_COLUMNS) == expected
    untouched = table.read().filter(~table.test(touched))
    assert {r[0] for r in rows(untouched, "RunTimeStamp")} <= {RAN}
    assert {f for f in files_before if f in files(table.path)} or len(touched) >= len(table.partitions())

    # The same day's whole run gives the same rows, all of them with its own time.
    store_run(table, loans[1], pays[1], stores, AT, LATER)
    assert rows(table.read(), *FACT_COLUMNS) == expected


def test_next_months_run_moves_span_rows(spark, tmp_path):
    rng = random.Random(9)
    stores = spark.createDataFrame([("z", "Zip"), ("m", "Mini Money"), ("q", None)], "Merchant_Store_Id string, Product string")
    loans = spark.createDataFrame(money([loan(rng, n) for n in range(1, 200)], (7, 8)), LOANS)
    pays = spark.createDataFrame(money([p for n in range(1, 200) for p in payments(rng, n)], (3,)), PAYMENTS)
    table = fact_table(spark, str(tmp_path / "facts"), loans)
    may = AsOf(date(2001, 5, 15), 3)
    store_run(table, loans, pays, stores, may, RAN, first=True)
    old = spark.createDataFrame(table.read().collect(), table.schema)
    expected = rows(load_facts(loans, pays, stores, AT, old.select(*FACT_COLUMNS)), *FACT_COLUMNS)
    touched = store_run(table, loans, pays, stores, AT, LATER)
    assert rows(table.read(), *FACT_COLUMNS) == expected
    # Loans of the window's first month have left it: their rows stay with the old run's time, in its partition.
    left = table.read().filter("Status = 'Active' AND Ref_Month = DATE'2001-05-01'")
    assert ("Active", date(2001, 5, 1)) in touched and left.count() and rows(left.select("RunTimeStamp").distinct()) == [(RAN,)]


def test_code_tests_reach_the_scan_of_stored_tables(spark):
    """Codes cleaned where the table was stored are compared as they are; rough ones are still cleaned."""
    from conftest import TINY

    from loanlens.operators.status import LOAN_CODES
    from loanlens.plans.catalog import Sample, loan_queries
    from loanlens.sources.tables import clean_codes

    pushed = {
        "L03_collections_m": "EqualTo(Loan_Status,R)", "L04_bankrupt": "EqualTo(Loan_Status,B)",
        "L08_default_m_status": "EqualTo(Loan_Status,R)", "L06_default_c": "In(Pmt_Type, [N,P])",
        "L18_renewed_2": "EqualTo(Loan_Type,R)",
    }
    queries = loan_queries()
    shown = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # plans print lists of filters in full
    try:
        for name, test in pushed.items():
            plan = queries[name](spark, TINY)._jdf.queryExecution().executedPlan().toString()
            assert test in plan.replace("\n", ""), name
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", shown)
    loans = Sample(spark, TINY).loan_appl()
    assert clean_codes(loans, LOAN_CODES) is loans
    rough = loans.withColumn("Loan_Status", F.concat(F.lower("Loan_Status"), F.lit("  ")))
    again = clean_codes(rough, LOAN_CODES)
    assert again is not rough and rows(again) == rows(loans)


def test_delete_window_cuts_a_partition_in_two(spark, tmp_path):
    table = fact_table(spark, str(tmp_path / "facts"), spark.createDataFrame([], LOANS))
    from loanlens.plans.fact import delete_window, stamped

    days = [date(2001, 4, 9), date(2001, 5, 9), date(2001, 5, 20), date(2001, 6, 1)]
    facts = [("s", "x", n, "c", status, d, d, d) for n, d in enumerate(days) for status in ("Due", "New")]
    schema = "Merch_Store_Id string, Subproduct string, Appl_No bigint, Cust_SSN string, Status string, From_Date date, To_Date date, Ref_Date date"
    table.create(stamped(spark.createDataFrame(facts, schema), RAN))
    before = files(table.path)
    reached = delete_window(table, ["Due"], date(2001, 5, 10))
    assert reached == {("Due", date(2001, 5, 1)), ("Due", date(2001, 6, 1))}
    assert rows(table.read().filter("Status = 'Due'"), "Appl_No") == [(0,), (1,)] and table.read().count() == 6
    assert {f for f in before if "Status=New" in f} <= files(table.path)
