"""Every operator as a named query over one folder of sample tables.

The loan tables, the status facts and the metric rows of a step are tables that several queries
read, just as a loan system and its nightly run store them once. They are derived from the whole
sample tables, written to the shared folder on first use, and found again by application, folder
and the state of its files.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.functions.dates import AsOf
from loanlens.operators import projections as P
from loanlens.operators import ratios as R
from loanlens.operators import sinks as K
from loanlens.operators import snapshots as S
from loanlens.operators.intervals import interval_join
from loanlens.operators.partitioned import PartitionedTable, merge
from loanlens.operators.rejects import FAULTS, Field, load_checked
from loanlens.operators.status import FACT_COLUMNS, FACT_KEY, LOAN_CODES, PAYMENT_CODES, classify, loans_with_product, renewals
from loanlens.plans import monthly as M
from loanlens.plans.fact import delete_window, fact_table, load_facts, stamped, store_changes, store_run, voided_loans
from loanlens.plans.resume import Stages
from loanlens.session import prepare, run_path, written
from loanlens.sources.calendar import calendar_of, month_starts, window_days
from loanlens.sources.sample import SampleTables
from loanlens.sources.tables import clean_codes

Query = Callable[[SparkSession, str], DataFrame]

AT = AsOf(date(2001, 6, 15))
EARLIER = AsOf(date(2001, 5, 15))
SIX_MONTHS = AsOf(AT.day, months_back=6)

_stored: dict[tuple, DataFrame] = {}


def plain(df: DataFrame) -> DataFrame:
    """Report form: decimals as doubles, dates and date-times as text."""

    def shown(field: T.StructField):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return col.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return col.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.substring(col.cast("string"), 1, 19).alias(field.name)
        return col.alias(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


class Sample(SampleTables):
    """Sample tables plus the tables a run stores."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(prepare(spark), folder)

    def _kept(self, name: str, build: Callable[[], DataFrame], partition_by: str | None = None) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, self._file_state(), name)
        if key not in _stored:
            _stored[key] = written(build(), name, partition_by)
        return _stored[key]

    def _file_state(self) -> int:
        """One number for the names, sizes and times of the folder's files; no content is read."""
        if not hasattr(self, "_state"):
            files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            seen = F.xxhash64("path", "length", "modificationTime")
            found = files.option("recursiveFileLookup", "true").load(self.folder).agg(F.bit_xor(seen)).first()
            self._state = found[0]
        return self._state

    def dim_merchant(self) -> DataFrame:
        return self._kept("dim_merchant", super().dim_merchant)

    def repeated_orders(self) -> DataFrame:
        return self._kept("repeated_orders", self._repeated_orders)

    def loan_appl(self, with_renewals: bool = True) -> DataFrame:
        build = super().loan_appl
        loans = self._kept("loan_appl", lambda: clean_codes(build(), LOAN_CODES))
        return loans if with_renewals else loans.drop("Ren_ApplNo")

    def payment(self) -> DataFrame:
        build = super().payment
        return self._kept("payment", lambda: clean_codes(build(), PAYMENT_CODES))

    def facts(self) -> DataFrame:
        # As they come: to gather them by status would shuffle them all once more.
        return self._kept("facts", lambda: load_facts(self.loan_appl(), self.payment(), self.dim_merchant(), AT))

    def placed_facts(self) -> DataFrame:
        return S.facts_with_store(self.facts(), self.dim_merchant())

    def stored_before(self, kind: M.MetricSet, until: str | None) -> DataFrame | None:
        """Metric rows stored when a step starts; None: after the last step."""
        table = None
        for name, step in M.steps(self.placed_facts(), AT, kind):
            if name == until:
                break
            rows = self._kept(f"{kind.name}-{name}", lambda step=step, table=table: step(table))
            table = rows if table is None else table.unionByName(rows)
        return table


def status(*names: str) -> Query:
    return lambda spark, folder: plain(_classified(Sample(spark, folder), AT, *names))


def _classified(t: Sample, at: AsOf, *names: str) -> DataFrame:
    return classify(t.loan_appl(), t.payment(), t.dim_merchant(), at, list(names)).select(*FACT_COLUMNS)


def renewal(*names: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        t = Sample(spark, folder)
        return plain(renewals(t.loan_appl(), t.dim_merchant(), AT, list(names)).select(*FACT_COLUMNS))

    return query


def fact_load(spark: SparkSession, folder: str) -> DataFrame:
    t = Sample(spark, folder)
    return plain(load_facts(t.loan_appl(), t.payment(), t.dim_merchant(), AT).select(*FACT_COLUMNS))


RAN, RAN_EARLIER = datetime(2001, 6, 15, 4, 30), datetime(2001, 5, 15, 4, 30)


def _before_voids(loans: DataFrame) -> DataFrame:
    """The loans of a time when today's voided ones were still open."""
    opened = F.when(F.col("Loan_Status") == "V", "O").otherwise(F.col("Loan_Status"))
    return clean_codes(loans.withColumn("Loan_Status", opened), LOAN_CODES)


def fact_load_second_run(spark: SparkSession, folder: str) -> DataFrame:
    """Last month's run stored by status and month, then today's into the same folder."""
    t = Sample(spark, folder)
    loans = t.loan_appl()
    table = fact_table(spark, run_path(spark, "fact_table"), loans)
    store_run(table, _before_voids(loans), t.payment(), t.dim_merchant(), EARLIER, RAN_EARLIER, first=True)
    store_run(table, loans, t.payment(), t.dim_merchant(), AT, RAN)
    return plain(table.read().drop("Ref_Month"))


def fact_load_changes(spark: SparkSession, folder: str) -> DataFrame:
    """A stored run of a time before some loans were voided, granted or paid on; then only what these reach."""
    t = Sample(spark, folder)
    loans, payments = t.loan_appl(), t.payment()
    granted, paid = F.col("Appl_No") % 50 == 7, F.col("Appl_No") % 40 == 3
    loans_before = _before_voids(loans).filter(~granted)
    table = fact_table(spark, run_path(spark, "fact_table"), loans)
    store_run(table, loans_before, payments.filter(~paid), t.dim_merchant(), AT, RAN_EARLIER, first=True)
    changed = loans.filter(granted | paid | (F.col("Loan_Status") == "V"))
    store_changes(table, loans, payments, t.dim_merchant(), AT, RAN, changed)
    return plain(table.read().drop("Ref_Month", "RunTimeStamp"))


def monthly_second_run(kind: M.MetricSet) -> Query:
    """Last month's run stored by month, then today's into the same folder."""

    def second(t: Sample) -> DataFrame:
        before = load_facts(_before_voids(t.loan_appl()), t.payment(), t.dim_merchant(), EARLIER)
        before = written(before, "facts_before")
        table = M.metric_table(t.spark, run_path(t.spark, "metric_table"), kind)
        table.create(M.run(before, t.dim_merchant(), EARLIER, kind))
        M.store_run(table, t.facts(), t.dim_merchant(), AT, kind)
        return table.read()

    return metric(kind, second)


def void_purge(spark: SparkSession, folder: str) -> DataFrame:
    """Due rows of a time when today's voided loans were still open, without the voided loans."""
    t = Sample(spark, folder)
    loans = t.loan_appl()
    due = classify(_before_voids(loans), t.payment(), t.dim_merchant(), AT, ["Due"])
    return plain(K.delete_by_key(due, voided_loans(loans), "Appl_No").select(*FACT_COLUMNS))


# -- sources and sinks -----------------------------------------------------------------------


def source_table(spark: SparkSession, folder: str) -> DataFrame:
    """The loan table as it is derived, not from the stored copy."""
    return plain(SampleTables(spark, folder).loan_appl())


def source_calendar(spark: SparkSession, folder: str) -> DataFrame:
    loans = Sample(spark, folder).loan_appl(with_renewals=False)
    return plain(window_days(calendar_of(loans, "Origin_Date"), AT))


def source_months(spark: SparkSession, folder: str) -> DataFrame:
    loans = Sample(spark, folder).loan_appl(with_renewals=False)
    return plain(month_starts(calendar_of(loans, "Origin_Date"), AT))


def _stored_facts(t: Sample, rows: DataFrame) -> PartitionedTable:
    table = fact_table(t.spark, run_path(t.spark, "fact_table"), t.loan_appl())
    table.create(stamped(rows, RAN_EARLIER))
    return table


def sink_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Stored Active rows of last month's run, updated with this month's: only partitions with rows of either are rewritten."""
    t = Sample(spark, folder)
    table = _stored_facts(t, _classified(t, EARLIER, "Active"))
    merge(table, written(stamped(_classified(t, AT, "Active"), RAN), "batch"), FACT_KEY)
    return plain(table.read().select(*FACT_COLUMNS))


def sink_delete_window(spark: SparkSession, folder: str) -> DataFrame:
    t = Sample(spark, folder)
    table = _stored_facts(t, _classified(t, AT, "Due", "Active"))
    delete_window(table, ["Due"], AsOf(AT.day, 3).window_opens_after)
    return plain(table.read().select(*FACT_COLUMNS))


def sink_delete_pattern(spark: SparkSession, folder: str) -> DataFrame:
    return plain(K.delete_projections(Sample(spark, folder).stored_before(M.V2, None)))


def sink_delete_by_key(spark: SparkSession, folder: str) -> DataFrame:
    t = Sample(spark, folder)
    return plain(K.delete_by_key(t.payment(), voided_loans(t.loan_appl(with_renewals=False)), "Appl_No"))


RAW_LOAN = [
    Field("Appl_No", "bigint", required=True),
    Field("Req_Loan_Amt", "decimal(12,2)", low="0", high="350000"),
    Field("Origin_Date", "date", required=True),
    Field("Loan_Status", "string", required=True, width=1),
]


def raw_loans(orders: DataFrame) -> DataFrame:
    """Loans as a file of texts would bring them, some of them damaged."""
    k = F.col("o_orderkey")
    day = F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd")
    amount = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    status = F.col("o_orderstatus")
    return orders.select(
        F.when(k % 29 == 0, None).when(k % 13 == 0, F.concat(F.lit("N"), k)).otherwise(k.cast("string")).alias("Appl_No"),
        F.when(k % 17 == 0, "12,5").when(k % 31 == 0, "-1").otherwise(amount).alias("Req_Loan_Amt"),
        F.when(k % 19 == 0, "2001-13-45").otherwise(day).alias("Origin_Date"),
        F.when(k % 23 == 0, F.concat(status, F.lit("x"))).when(k % 37 == 0, None).otherwise(status).alias("Loan_Status"),
    )


def sink_reject_typed(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that do not fit their target, as they came, with every fault: a report, so no share of them stops it."""
    rows = raw_loans(Sample(spark, folder).raw("orders"))
    _, bad, _ = load_checked(spark, rows, RAW_LOAN, most=1.0)
    names = [f.name for f in RAW_LOAN]
    return bad.select(
        *names,
        F.array_join(F.transform(FAULTS, lambda f: f["errorCode"]), ", ").alias("errorCode"),
        F.array_join(F.transform(FAULTS, lambda f: f["errorMessage"]), ", ").alias("errorMessage"),
    )


# -- irregular periods -----------------------------------------------------------------------


def irregular_periods(nation: DataFrame) -> DataFrame:
    """Periods of some hours, days or weeks, with overlaps and gaps: (period, opens, closes)."""
    k = F.col("n_nationkey").cast("int")
    length = F.when(k % 3 == 0, 5).when(k % 3 == 1, 40).otherwise(200) + k
    opens = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=24 * k + 7 * (k % 5))
    return nation.select(k.alias("period"), opens.alias("opens"), (opens + F.make_dt_interval(hours=length)).alias("closes"))


def interval_event_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Events and their value per irregular period and kind; an event counts in every period that holds it."""
    t = Sample(spark, folder)
    events = t.raw("events").select(
        F.col("ts").cast("timestamp_ntz").alias("at"), "event_type", F.col("value").cast("decimal(12,2)").alias("value")
    )
    held = interval_join(events, irregular_periods(t.raw("nation")), "at", "opens", "closes", finest=6 * 3600)
    return plain(held.groupBy("period", "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("total")))


def interval_open_loans(spark: SparkSession, folder: str) -> DataFrame:
    """Customers and loans active on days that no calendar spaces evenly, per product."""
    t = Sample(spark, folder)
    k = F.col("n_nationkey").cast("int")
    days = t.raw("nation").select(F.date_add(F.lit("2000-06-05").cast("date"), 14 * k + 2 * (k % 4)).alias("day"))
    spans = t.placed_facts().filter("Status = 'Active'").select("From_Date", "To_Date", "Product", "Cust_SSN", "Appl_No")
    held = interval_join(days, spans, "day", "From_Date", "To_Date", closed=True)
    return plain(
        held.groupBy("day", "Product").agg(
            F.count_distinct("Cust_SSN").alias("customers"), F.count_distinct("Appl_No").alias("loans")
        )
    )


def monthly_run_resumed(spark: SparkSession, folder: str) -> DataFrame:
    """A run that breaks off before its third stage, and a second one that goes on from there."""

    def resumed(t: Sample) -> DataFrame:
        facts, merchants = t.facts(), t.dim_merchant()
        stages = Stages(spark, run_path(spark, "stages"), t._file_state(), AT, M.V2.name)

        def broken(df: DataFrame, name: str) -> DataFrame:
            if name.endswith("stage2"):
                raise InterruptedError(name)
            return stages(df, name)

        with suppress(InterruptedError):
            M.run(facts, merchants, AT, M.V2, cut=broken)
        return stages.finish(lambda: written(M.run(facts, merchants, AT, M.V2, cut=stages), "resumed"))

    return metric(M.V2, resumed)(spark, folder)


def sink_reject(spark: SparkSession, folder: str) -> DataFrame:
    """Loans that cannot become fact rows because their store has no product."""
    t = Sample(spark, folder)
    rows = loans_with_product(t.loan_appl(with_renewals=False), t.dim_merchant()).select(
        "Merch_Store_Id", "Subproduct", "Appl_No", "Cust_SSN", F.col("Loan_Status").alias("Status")
    )
    return plain(K.split_rejects(rows, FACT_KEY)[1])


# -- metrics ---------------------------------------------------------------------------------


def metric(kind: M.MetricSet, build: Callable[[Sample], DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = build(Sample(spark, folder))
        if "AsOf_Date" not in rows.columns:
            rows = rows.withColumn("AsOf_Date", F.lit(None).cast("date"))
        return plain(rows.select(*S.metric_columns(kind.with_subproduct)))

    return query


def _flows(t: Sample, sub: bool, default_any: bool) -> DataFrame:
    is_any = F.col("Metric") == S.DEFAULT_ANY
    events = S.window_events(t.placed_facts(), AT)
    return S.flow_counts(events.filter(is_any if default_any else ~is_any), sub)


def _flow_projection(t: Sample, sub: bool, default_any: bool) -> DataFrame:
    is_any = F.col("base_metric") == S.DEFAULT_ANY
    events = P.recent_events(t.placed_facts(), AT)
    return P.flow_projection(events.filter(is_any if default_any else ~is_any), AT, sub)


def _current(t: Sample, kind: M.MetricSet, step: str) -> DataFrame:
    return t.stored_before(kind, step).filter(F.col("Dateref") == F.lit(AT.month))


def metric_set_queries(kind: M.MetricSet) -> dict[str, Query]:
    """The operators of one metric set; both sets have the same ones."""
    sub = kind.with_subproduct

    def levels() -> list[R.Level]:
        return R.levels(sub)  # columns, so only once a session runs

    found: dict[str, Callable[[Sample], DataFrame]] = {
        "M01_bom_snapshot": lambda t: S.snapshots(S.month_bounds(t.placed_facts(), AT), AT, sub, ["BOM"]),
        "M02_eom_snapshot": lambda t: S.snapshots(S.month_bounds(t.placed_facts(), AT), AT, sub, ["EOM"]),
        "M05_flow_counts": lambda t: _flows(t, sub, False),
        "M06_default_any": lambda t: _flows(t, sub, True),
        "M20_gross_churn": lambda t: R.churn(t.stored_before(kind, "churn"), sub, ["Gross Churn"]),
        "M22_net_churn": lambda t: R.churn(t.stored_before(kind, "churn"), sub, ["Net Churn"]),
        "M24_flow_projection": lambda t: _flow_projection(t, sub, False),
        "M25_default_any_projection": lambda t: _flow_projection(t, sub, True),
        "M26_active_delta_projection": lambda t: P.delta_projection(
            t.stored_before(kind, "projection"), AT, sub, [R.ACTIVE_DELTA]
        ),
        "M27_collections_delta_projection": lambda t: P.delta_projection(
            t.stored_before(kind, "projection"), AT, sub, [R.COLL_DELTA]
        ),
        "M28_gross_churn_proj": lambda t: R.churn_projection(
            _current(t, kind, "churn_projected"), sub, ["Gross Churn Proj"]
        ),
        "M30_net_churn_proj": lambda t: R.churn_projection(
            _current(t, kind, "churn_projected"), sub, ["Net Churn Proj"]
        ),
        "M19_level_rollup": lambda t: M.derived(t.stored_before(kind, "derived"), AT, kind),
        "M32_ratio_proj": lambda t: R.ratio_projection(_current(t, kind, "closing"), sub, levels()),
    }
    if kind.closing == "zero":
        found["M03_eom_zero_current"] = lambda t: S.closing_zero(t.placed_facts(), AT, sub)
    else:
        found["M04_eom_mtd"] = lambda t: S.closing_to_date(S.open_on(t.placed_facts(), AT.day), AT, sub)
    for op, counted in RATIO_OPS.items():
        found[op] = lambda t, counted=counted: R.ratios(
            t.stored_before(kind, "derived"), sub, levels(), kind.with_loans, [counted]
        )
    for op, name in ROLL_OPS.items():
        found[op] = lambda t, name=name: R.roll_forward(t.stored_before(kind, "derived"), sub, kind.with_loans, [name])
    for op, name in {"M21_gross_churn_pct": "Gross Churn Pct", "M23_net_churn_pct": "Net Churn Pct"}.items():
        found[op] = lambda t, name=name: R.churn_pct(
            t.stored_before(kind, "churn"), sub, levels(), kind.churn_base, [name]
        )
    for op, name in {"M29_gross_churn_pct_proj": "Gross Churn Pct", "M31_net_churn_pct_proj": "Net Churn Pct"}.items():
        found[op] = lambda t, name=name: R.churn_pct_projection(
            _current(t, kind, "churn_projected"), sub, levels(), kind.churn_base_proj, [name]
        )
    for op, name in CLOSING_OPS.items():
        found[op] = lambda t, name=name: R.closing_projection(
            _current(t, kind, "closing"), sub, kind.with_current_delta, [name]
        )
    return {f"{op}_{kind.name}": metric(kind, build) for op, build in sorted(found.items())}


RATIO_OPS = {
    "M07_default_principal_pct": R.DEF_PRINCIPAL,
    "M08_paid_off_pct": R.PAID,
    "M09_reactivated_pct": R.REACTIVATED,
    "M10_new_pct": R.NEW,
    "M11_reloaned_pct": R.RELOANED,
    "M12_charged_off_pct": R.CHARGED_OFF,
    "M13_default_any_pct": R.DEF_ANY,
    "M14_paid_after_default_pct": R.PAID_LATE,
}
ROLL_OPS = {
    "M15_active_eom_calc": "Active EOM Calculated",
    "M16_active_eom_delta": "Active EOM Delta",
    "M17_collections_eom_calc": "Collections EOM Calculated",
    "M18_collections_eom_delta": "Collections EOM Delta",
}
CLOSING_OPS = {
    "M33_active_eom_calc_proj": "Active EOM Calculated Proj",
    "M34_active_eom_proj": "Active EOM Proj",
    "M35_collections_eom_calc_proj": "Collections EOM Calculated Proj",
    "M36_collections_eom_proj": "Collections EOM Proj",
}


def mini_only_queries() -> dict[str, Query]:
    kind = M.V2

    def snapshots(t: Sample) -> DataFrame:
        return S.snapshots(S.mini_only_spans(S.month_bounds(t.placed_facts(), AT)), AT, True, M.ALL_COUNTS)

    def flows(t: Sample) -> DataFrame:
        facts = t.placed_facts()
        return S.flow_counts(S.mini_only_events(S.window_events(facts, AT), facts), True)

    builds: dict[str, Callable[[Sample], DataFrame]] = {
        "M37_mini_only_snapshots": snapshots,
        "M38_mini_only_flows": flows,
        "M39_mini_only_ratios": lambda t: M.derived_mini_only(t.stored_before(kind, "derived_mini_only"), AT, kind),
        "M40_mini_only_churn_pct": lambda t: M.churn_mini_only(t.stored_before(kind, "churn_mini_only"), AT, kind),
        "M41_mini_only_projection": lambda t: M.projection_mini_only(t.placed_facts(), AT, kind),
        "M42_mini_only_churn_pct_proj": lambda t: M.churn_projected_mini_only(
            t.stored_before(kind, "churn_projected_mini_only"), AT, kind
        ),
        "M43_mini_only_ratio_proj": lambda t: M.closing_mini_only(
            t.stored_before(kind, "closing_mini_only"), AT, kind
        ),
    }
    return {op: metric(kind, build) for op, build in builds.items()}


def monthly_run(kind: M.MetricSet, at: AsOf = AT) -> Query:
    """A whole run over the stored facts; nothing of it is kept from earlier queries."""
    return metric(kind, lambda t: M.run(t.facts(), t.dim_merchant(), at, kind))


STATUS_OPS = {
    "L01_active": ["Active"],
    "L02_collections": ["Collections"],
    "L03_collections_m": ["Collections_M"],
    "L04_bankrupt": ["Bankrupt"],
    "L05_charged_off": ["Charged off"],
    "L06_default_c": ["Default_C"],
    "L07_default_p": ["Default_P"],
    "L08_default_m_status": ["Default_M"],
    "L09_default_m_payment": ["Default_M by payment"],
    "L10_due": ["Due"],
    "L11_new": ["New"],
    "L12_react": ["React"],
    "L13_paid_d": ["Paid_D"],
    "L14_paid_p": ["Paid_P"],
    "L15_paidrel_1": ["PaidRel_1"],
    "L16_paidrel_2": ["PaidRel_2"],
}


def loan_queries() -> dict[str, Query]:
    return {
        "src_table": source_table,
        "src_calendar": source_calendar,
        "src_month_starts": source_months,
        "sink_upsert": sink_upsert,
        "sink_delete_window": sink_delete_window,
        "sink_delete_pattern": sink_delete_pattern,
        "sink_delete_by_key": sink_delete_by_key,
        "sink_reject": sink_reject,
        "sink_reject_typed": sink_reject_typed,
        "interval_event_periods": interval_event_periods,
        "interval_open_loans": interval_open_loans,
        **{op: status(*names) for op, names in STATUS_OPS.items()},
        "L17_renewed_1": renewal("Renewed_1"),
        "L18_renewed_2": renewal("Renewed_2"),
        "L19_void_purge": void_purge,
        "L20_fact_load": fact_load,
        "fact_load_second_run": fact_load_second_run,
        "fact_load_changes": fact_load_changes,
        **metric_set_queries(M.V1),
        **metric_set_queries(M.V2),
        **mini_only_queries(),
        "monthly_run_v1": monthly_run(M.V1),
        "monthly_run_v2": monthly_run(M.V2),
        "monthly_run_v2_plain": monthly_run(M.V2_PLAIN),
        "monthly_run_v2_six_months": monthly_run(M.V2, SIX_MONTHS),
        "pipeline_monthly": monthly_run(M.V1),
        "monthly_run_resumed": monthly_run_resumed,
        "monthly_run_second_v1": monthly_second_run(M.V1),
        "monthly_run_second_v2": monthly_second_run(M.V2),
    }
