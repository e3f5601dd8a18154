"""The monthly metric run: six steps, each reading what the steps before it stored.

Two metric sets exist. They share every operator and differ only in the options of `MetricSet`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.functions.dates import AsOf, month_start
from loanlens.functions.loan import METRIC_VALUE
from loanlens.operators import projections as P
from loanlens.operators import ratios as R
from loanlens.operators import snapshots as S
from loanlens.operators.partitioned import PartitionedTable, equal
from loanlens.operators.sinks import delete_projections, upsert
from loanlens.session import written

Cut = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class MetricSet:
    name: str
    with_subproduct: bool
    closing: str  # current month's closing counts: "zero" or "to date"
    with_loans: bool  # ratios and roll-forward also for loans
    churn_base: tuple[str, ...]
    churn_base_proj: tuple[str, ...]
    with_current_delta: bool
    mini_only: bool


V1 = MetricSet("v1", False, "zero", False, (R.ACTIVE_BOM,), (R.ACTIVE_BOM,), True, False)
V2 = MetricSet(
    "v2", True, "to date", True,
    (R.ACTIVE_BOM, R.NEW), (R.ACTIVE_BOM, R.NEW, R.proj(R.NEW)), False, True,
)
V2_PLAIN = MetricSet(**{**V2.__dict__, "name": "v2_plain", "mini_only": False})

ALL_COUNTS = ("BOM", "EOM", "TODAY")

# Small loans only: churn over the opening count alone, in both metric sets.
MINI_ONLY_BASE = (R.ACTIVE_BOM,)


def metric_key(kind: MetricSet) -> list[str]:
    return [*S.dimensions(kind.with_subproduct), "Metric", "Dateref"]


def _shaped(df: DataFrame, kind: MetricSet) -> DataFrame:
    if "AsOf_Date" not in df.columns:
        df = df.withColumn("AsOf_Date", F.lit(None).cast("date"))
    return df.select(*S.metric_columns(kind.with_subproduct))


def _union(parts: list[DataFrame], kind: MetricSet) -> DataFrame:
    return reduce(DataFrame.unionByName, [_shaped(p, kind) for p in parts])


def _only_month(stored: DataFrame, at: AsOf) -> DataFrame:
    return stored.filter(F.col("Dateref") == F.lit(at.month))


# -- the steps: facts with store dimensions, or stored metrics -> new metric rows --------------


def base(facts: DataFrame, at: AsOf, kind: MetricSet) -> DataFrame:
    bounds = S.month_bounds(facts, at)
    if kind.closing == "zero":
        counted = _shaped(S.snapshots(bounds, at, kind.with_subproduct), kind)
        # The current month's closing rows replace the counted ones with the same key.
        counted = upsert(counted, _shaped(S.closing_zero(facts, at, kind.with_subproduct), kind), metric_key(kind))
    else:
        counted = _shaped(S.snapshots(bounds, at, kind.with_subproduct, ALL_COUNTS), kind)
    flows = S.flow_counts(S.window_events(facts, at), kind.with_subproduct)
    return counted.unionByName(_shaped(flows, kind))


def base_mini_only(facts: DataFrame, at: AsOf, kind: MetricSet) -> DataFrame:
    spans = S.mini_only_spans(S.month_bounds(facts, at))
    counted = _shaped(S.snapshots(spans, at, kind.with_subproduct, ALL_COUNTS), kind)
    flows = S.flow_counts(S.mini_only_events(S.window_events(facts, at), facts), kind.with_subproduct)
    return counted.unionByName(_shaped(flows, kind))


def derived(stored: DataFrame, at: AsOf, kind: MetricSet) -> DataFrame:
    sub = kind.with_subproduct
    levels = R.levels(sub)
    return _union(
        [R.ratios(stored, sub, levels, kind.with_loans), R.roll_forward(stored, sub, kind.with_loans)], kind
    )


def derived_mini_only(stored: DataFrame, at: AsOf, kind: MetricSet) -> DataFrame:
    return _shaped(R.ratios(stored, kind.with_subproduct, R.mini_only_level(), False), kind)


def churn(stored: DataFrame, at: AsOf, kind: MetricSet) -> DataFrame:
    sub = kind.with_subproduct
    return _union([R.churn(stored, sub), R.churn_pct(stored, sub, R.levels(sub), kind.churn_base)], kind)


def churn_mini_only(stored: DataFrame, at: AsOf, kind: MetricSet) -> DataFrame:
    return _shaped(R.churn_pct(stored, kind.with_subproduct, R.mini_only_level(), MINI_ONLY_BASE), kind)


def projection(facts: DataFrame, stored: DataFrame, at: AsOf, kind: MetricSet) -> DataFrame:
    sub = kind.with_subproduct
    return _union(
        [
            P.flow_projection(P.recent_events(facts, at), at, sub),
            P.delta_projection(stored, at, sub, [R.ACTIVE_DELTA, R.COLL_DELTA]),
        ],
        kind,
    )


def projection_mini_only(facts: DataFrame, at: AsOf, kind: MetricSet) -> DataFrame:
    events = S.mini_only_recent_events(P.recent_events(facts, at), facts, at)
    return _shaped(P.flow_projection(events, at, kind.with_subproduct), kind)


def churn_projected(stored: DataFrame, at: AsOf, kind: MetricSet) -> DataFrame:
    sub, current = kind.with_subproduct, _only_month(stored, at)
    return _union(
        [
            R.churn_projection(current, sub),
            R.churn_pct_projection(current, sub, R.levels(sub), kind.churn_base_proj),
        ],
        kind,
    )


def churn_projected_mini_only(stored: DataFrame, at: AsOf, kind: MetricSet) -> DataFrame:
    current = _only_month(stored, at)
    return _shaped(
        R.churn_pct_projection(current, kind.with_subproduct, R.mini_only_level(), MINI_ONLY_BASE), kind
    )


def closing(stored: DataFrame, at: AsOf, kind: MetricSet) -> DataFrame:
    sub, current = kind.with_subproduct, _only_month(stored, at)
    return _union(
        [
            R.ratio_projection(current, sub, R.levels(sub)),
            R.closing_projection(current, sub, kind.with_current_delta),
        ],
        kind,
    )


def closing_mini_only(stored: DataFrame, at: AsOf, kind: MetricSet) -> DataFrame:
    return _shaped(R.ratio_projection(_only_month(stored, at), kind.with_subproduct, R.mini_only_level()), kind)


# -- the run ---------------------------------------------------------------------------------


def steps(
    facts: DataFrame, at: AsOf, kind: MetricSet
) -> Iterator[tuple[str, Callable[[DataFrame | None], DataFrame]]]:
    """Step names in order, each with a function from the rows stored so far to the step's rows."""
    # `facts` carry store dimensions; each step may read them and the stored metrics.
    yield "base", lambda stored: base(facts, at, kind)
    if kind.mini_only:
        yield "base_mini_only", lambda stored: base_mini_only(facts, at, kind)
    yield "derived", lambda stored: derived(stored, at, kind)
    if kind.mini_only:
        yield "derived_mini_only", lambda stored: derived_mini_only(stored, at, kind)
    yield "churn", lambda stored: churn(stored, at, kind)
    if kind.mini_only:
        yield "churn_mini_only", lambda stored: churn_mini_only(stored, at, kind)
    yield "projection", lambda stored: projection(facts, stored, at, kind)
    if kind.mini_only:
        yield "projection_mini_only", lambda stored: projection_mini_only(facts, at, kind)
    yield "churn_projected", lambda stored: churn_projected(stored, at, kind)
    if kind.mini_only:
        yield "churn_projected_mini_only", lambda stored: churn_projected_mini_only(stored, at, kind)
    yield "closing", lambda stored: closing(stored, at, kind)
    if kind.mini_only:
        yield "closing_mini_only", lambda stored: closing_mini_only(stored, at, kind)


# Steps of one stage read what earlier stages stored and nothing of each other, so that a
# stage is one job with one write.
STAGES = [
    ("base", "base_mini_only"),
    ("derived", "derived_mini_only"),
    ("churn", "churn_mini_only", "projection", "projection_mini_only"),
    ("churn_projected", "churn_projected_mini_only", "closing", "closing_mini_only"),
]


def run(
    facts: DataFrame,
    merchants: DataFrame,
    at: AsOf,
    kind: MetricSet,
    stored: DataFrame | None = None,
    until: str | None = None,
    cut: Cut = written,
) -> DataFrame:
    """The metric table after a run, or the rows stored when the stage of step `until` is about to start.

    `stored` holds the metrics of earlier runs: their projections are purged first, and keys
    that the run reaches again are replaced, all others stay. A stage writes its own rows only; the
    stored ones are read past those that new rows replace.
    """
    dims = S.facts_with_store(facts, merchants)
    old = None if stored is None else delete_projections(stored)
    key = metric_key(kind)
    fresh = None
    by_name = dict(steps(dims, at, kind))
    for number, stage in enumerate(STAGES):
        if until in stage:
            break
        table = _seen(old, fresh, key)
        rows = _union([by_name[name](table) for name in stage if name in by_name], kind)
        if old is not None and number:
            # Derived rows carry no day of their own: the stored one stays.
            days = old.select(*key, "AsOf_Date").alias("t")
            rows = rows.drop("AsOf_Date").alias("b").join(days, equal(key, "t", "b"), "left").select("b.*", "t.AsOf_Date")
        rows = cut(_shaped(rows, kind), f"{kind.name}-stage{number}")
        fresh = rows if fresh is None else fresh.unionByName(rows)
    return _seen(old, fresh, key)


def _seen(old: DataFrame | None, fresh: DataFrame | None, key: list[str]) -> DataFrame | None:
    """What is stored once `fresh` has replaced rows of `old`."""
    if old is None or fresh is None:
        return old if fresh is None else fresh
    return old.alias("t").join(fresh.select(*key).alias("b"), equal(key, "t", "b"), "left_anti").unionByName(fresh)


# -- the stored metric table, split by month -------------------------------------------------


def metric_table(spark: SparkSession, path: str, kind: MetricSet) -> PartitionedTable:
    text, day, value = T.StringType(), T.DateType(), T._parse_datatype_string(METRIC_VALUE)
    kinds = {c: text for c in S.metric_columns(kind.with_subproduct)}
    kinds |= {"Value_Cust": value, "Value_Loan": value, "AsOf_Date": day}
    kinds.pop("Dateref")
    kinds["Dateref"] = day
    return PartitionedTable(spark, path, T.StructType([T.StructField(n, k) for n, k in kinds.items()]), ("Dateref",))


def store_run(table: PartitionedTable, facts: DataFrame, merchants: DataFrame, at: AsOf, kind: MetricSet) -> set[tuple]:
    """One run into the stored table; returns the months that were rewritten.

    A run reaches the months of its window and nothing before; it also purges projections, wherever
    they are. Rows of a month depend on rows of that month, and projections on those of the window.
    """
    window = {(month_start(at.month, -k),) for k in range(at.months_back)}
    projected = table.partitions(table.outside(window).filter(F.col("Metric").endswith("Proj")))
    rows = run(facts, merchants, at, kind, stored=table.within(window)).select(*table.schema.names)
    table.replace(window | projected, rows.unionByName(delete_projections(table.within(projected))))
    return window | projected
