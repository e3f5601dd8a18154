"""Metrics derived from stored metrics: ratios, roll-forward, churn and their projections.

All formulas are sums of stored metrics, so each step needs one pass: every stored row is tagged
with the levels it counts into, one grouping sums the needed metrics side by side, and the
formulas are evaluated on the summed row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.loan import METRIC_VALUE, MINI, MINI_ONLY, POCKET, ZIP, ratio
from loanlens.operators.snapshots import dimensions

# Metric names.
ACTIVE_BOM, ACTIVE_EOM, ACTIVE_DELTA = "Active BOM", "Active EOM", "Active EOM Delta"
COLL_BOM, COLL_EOM, COLL_DELTA = "Collections BOM", "Collections EOM", "Collections EOM Delta"
NEW, REACTIVATED, RELOANED = "New", "Reactivated", "Reloaned"
PAID, PAID_LATE = "Paid Off", "Paid Off after Default"
DEF_PRINCIPAL, DEF_ANY, CHARGED_OFF = "Default (Principal)", "Default (Any)", "Charged Off"

# The eight ratios, by counted metric and the opening metrics it is divided by.
RATIOS = {
    DEF_PRINCIPAL: [ACTIVE_BOM],
    PAID: [ACTIVE_BOM],
    REACTIVATED: [ACTIVE_BOM],
    NEW: [ACTIVE_BOM],
    RELOANED: [ACTIVE_BOM, NEW, REACTIVATED],
    CHARGED_OFF: [COLL_BOM],
    DEF_ANY: [COLL_BOM],
    PAID_LATE: [COLL_BOM],
}

Sums = Callable[[str], Column]
Formula = Callable[[Sums], Column]


@dataclass(frozen=True)
class Level:
    """A roll-up level: the rows it takes, the dimensions it keeps, and its name suffix."""

    suffix: str
    takes: Column
    keeps: tuple[str, ...]


# The dimensions by which a level takes or keeps rows.
CELL = ("Business_Unit", "Product", "Subproduct")


def _filled(name: str) -> Column:
    return F.trim(F.col(name)) != ""


def levels(with_subproduct: bool) -> list[Level]:
    """All products of a unit, the two main products, the small loans; optionally Zip's sub-products."""
    found = [
        Level("", _filled("Business_Unit"), ("Business_Unit", "Product")),
        Level("Pocket Zip", F.col("Product").isin(ZIP, POCKET), ()),
        Level("Mini", F.col("Product") == MINI, ()),
    ]
    if with_subproduct:
        sub = _filled("Business_Unit") & (F.col("Product") == ZIP) & _filled("Subproduct")
        found.append(Level("Sub", sub, ("Business_Unit", "Product", "Subproduct")))
    return found


def mini_only_level() -> list[Level]:
    return [Level("Mini Only", F.col("Product") == MINI_ONLY, ())]


def _column(metric: str, value: str) -> str:
    return f"{metric}|{value}"


def _aggregates(metrics: Sequence[str], values: Sequence[str]) -> list[Column]:
    """Each metric's sum as a column of its own; rows of other metrics add nothing."""
    return [
        F.expr(f"sum(CASE WHEN Metric = '{m}' THEN {v} ELSE 0 END) AS `{_column(m, v)}`") for m in metrics for v in values
    ]


def _reader(value: str) -> Sums:
    return lambda metric: F.col(f"`{_column(metric, value)}`")


def _rows(
    summed: DataFrame, keys: Sequence[str], suffix: Column | None, formulas: dict[str, Formula], with_loans: bool
) -> DataFrame:
    """One output row per formula. Without loan values the loan column stays NULL."""

    def row(name: str, formula: Formula) -> Column:
        full = F.lit(name) if suffix is None else F.concat(F.lit(name), suffix)
        loans = formula(_reader("Value_Loan")) if with_loans else F.lit(None)
        return F.struct(
            full.alias("Metric"),
            formula(_reader("Value_Cust")).cast(METRIC_VALUE).alias("Value_Cust"),
            loans.cast(METRIC_VALUE).alias("Value_Loan"),
        )

    inlined = F.inline(F.array(*[row(n, f) for n, f in formulas.items()]))
    return summed.select(*keys, "Dateref", inlined).select(*keys, "Metric", "Dateref", "Value_Cust", "Value_Loan")


def by_level(
    stored: DataFrame,
    with_subproduct: bool,
    at_levels: Sequence[Level],
    formulas: dict[str, Formula],
    needed: Sequence[str],
    with_loans: bool = False,
    name_tail: str = "",
) -> DataFrame:
    """Evaluate formulas at several roll-up levels in one pass.

    Only rows of the needed metrics carry a value, but every stored row of a group makes the
    group appear; dimensions that a level rolls up are blank. Levels know a row by its unit, product and
    sub-product only: the rows are summed to such cells first, and just the cells are copied per level.
    """
    dims = dimensions(with_subproduct)
    cell = [d for d in dims if d in CELL]

    def tag(level: Level) -> Column:
        kept = [(F.col(d) if d in level.keeps else F.lit(" ")).alias(d) for d in dims]
        label = " " + level.suffix if level.suffix else ""
        return F.when(level.takes, F.struct(F.lit(label + name_tail).alias("suffix"), *kept))

    tags = F.array(*[tag(level) for level in at_levels])
    values = ["Value_Cust", "Value_Loan"] if with_loans else ["Value_Cust"]
    cells = stored.groupBy(*cell, "Dateref").agg(*_aggregates(needed, values))
    sums = [_column(m, v) for m in needed for v in values]
    added = [F.sum(f"`{c}`").cast(cells.schema[c].dataType).alias(c) for c in sums]
    summed = (
        cells.select(F.explode(tags).alias("t"), "Dateref", *[f"`{c}`" for c in sums])
        .filter(F.col("t").isNotNull())
        .groupBy("t.suffix", *[f"t.{d}" for d in dims], "Dateref")
        .agg(*added)
    )
    return _rows(summed, dims, F.col("suffix"), formulas, with_loans)


def by_store(
    stored: DataFrame,
    with_subproduct: bool,
    formulas: dict[str, Formula],
    needed: Sequence[str],
    with_loans: bool = False,
) -> DataFrame:
    """Evaluate formulas per full set of dimensions (rolled-up rows have a blank region)."""
    dims = dimensions(with_subproduct)
    values = ["Value_Cust", "Value_Loan"] if with_loans else ["Value_Cust"]
    summed = stored.filter(_filled("Region")).groupBy(*dims, "Dateref").agg(*_aggregates(needed, values))
    return _rows(summed, dims, None, formulas, with_loans)


def proj(metric: str) -> str:
    return f"{metric} Proj"


def _with_proj(metrics: Sequence[str]) -> list[str]:
    return [*metrics, *[proj(m) for m in metrics]]


# -- ratios and roll-forward ---------------------------------------------------------------


def _total(s: Sums, metrics: Sequence[str]) -> Column:
    found = s(metrics[0])
    for metric in metrics[1:]:
        found = found + s(metric)
    return found


def ratio_formulas(counted: Sequence[str] = tuple(RATIOS)) -> dict[str, Formula]:
    def formula(metric: str) -> Formula:
        return lambda s: ratio(s(metric), _total(s, RATIOS[metric]))

    return {f"{m} Pct": formula(m) for m in counted}


def ratio_projection_formulas(counted: Sequence[str] = tuple(RATIOS)) -> dict[str, Formula]:
    """The ratios with the projected rest of the month added; opening counts need no projection."""

    def formula(metric: str) -> Formula:
        opening = [m for m in RATIOS[metric] if m in (ACTIVE_BOM, COLL_BOM)]
        flows = [m for m in RATIOS[metric] if m not in opening]
        return lambda s: ratio(_total(s, _with_proj([metric])), _total(s, opening + _with_proj(flows)))

    return {f"{m} Pct": formula(m) for m in counted}


def ratios(
    stored: DataFrame,
    with_subproduct: bool,
    at_levels: Sequence[Level],
    with_loans: bool,
    counted: Sequence[str] = tuple(RATIOS),
) -> DataFrame:
    needed = sorted({*counted, *[m for c in counted for m in RATIOS[c]]})
    return by_level(stored, with_subproduct, at_levels, ratio_formulas(counted), needed, with_loans)


def _active_calc(s: Sums) -> Column:
    return s(ACTIVE_BOM) - s(DEF_PRINCIPAL) - s(PAID) + s(REACTIVATED) + s(NEW)


def _collections_calc(s: Sums) -> Column:
    return s(COLL_BOM) + s(DEF_ANY) - s(PAID_LATE) - s(CHARGED_OFF)


def _gap(observed: str, calculated: Formula) -> Formula:
    """Observed closing count less the calculated one; zero where nothing was observed."""
    return lambda s: F.when(s(observed) == 0, F.lit(0)).otherwise(s(observed) - calculated(s))


ROLL_FORWARD: dict[str, Formula] = {
    "Active EOM Calculated": _active_calc,
    ACTIVE_DELTA: _gap(ACTIVE_EOM, _active_calc),
    "Collections EOM Calculated": _collections_calc,
    COLL_DELTA: _gap(COLL_EOM, _collections_calc),
}
ROLL_FORWARD_NEEDS = [
    ACTIVE_BOM, ACTIVE_EOM, DEF_PRINCIPAL, PAID, REACTIVATED, NEW,
    COLL_BOM, COLL_EOM, DEF_ANY, PAID_LATE, CHARGED_OFF,
]


def _only(formulas: dict[str, Formula], names: Sequence[str] | None) -> dict[str, Formula]:
    return {n: f for n, f in formulas.items() if names is None or n in names}


def roll_forward(
    stored: DataFrame, with_subproduct: bool, with_loans: bool, names: Sequence[str] | None = None
) -> DataFrame:
    return by_store(stored, with_subproduct, _only(ROLL_FORWARD, names), ROLL_FORWARD_NEEDS, with_loans)


# -- churn ---------------------------------------------------------------------------------

CHURN_NEEDS = [PAID, DEF_PRINCIPAL, ACTIVE_DELTA, REACTIVATED, ACTIVE_BOM, NEW]


def _gross(s: Sums) -> Column:
    return s(PAID) + s(DEF_PRINCIPAL) - s(ACTIVE_DELTA)


def _net(s: Sums) -> Column:
    return _gross(s) - s(REACTIVATED)


CHURN: dict[str, Formula] = {"Gross Churn": _gross, "Net Churn": _net}


def churn_pct_formulas(base: Sequence[str]) -> dict[str, Formula]:
    return {
        "Gross Churn Pct": lambda s: ratio(_gross(s), _total(s, base)),
        "Net Churn Pct": lambda s: ratio(_net(s), _total(s, base)),
    }


def churn(stored: DataFrame, with_subproduct: bool, names: Sequence[str] | None = None) -> DataFrame:
    return by_store(stored, with_subproduct, _only(CHURN, names), CHURN_NEEDS)


def churn_pct(
    stored: DataFrame,
    with_subproduct: bool,
    at_levels: Sequence[Level],
    base: Sequence[str],
    names: Sequence[str] | None = None,
) -> DataFrame:
    return by_level(stored, with_subproduct, at_levels, _only(churn_pct_formulas(base), names), CHURN_NEEDS)


# -- projections of the current month (the caller passes rows of that month only) -----------

CHURN_PROJ_NEEDS = [
    *_with_proj([PAID, DEF_PRINCIPAL, REACTIVATED, NEW]), proj(ACTIVE_DELTA), ACTIVE_BOM,
]


def _gross_proj(s: Sums) -> Column:
    return s(proj(PAID)) + s(proj(DEF_PRINCIPAL)) - s(proj(ACTIVE_DELTA))


def _net_proj(s: Sums) -> Column:
    return _gross_proj(s) - s(proj(REACTIVATED))


CHURN_PROJ: dict[str, Formula] = {"Gross Churn Proj": _gross_proj, "Net Churn Proj": _net_proj}


def churn_projection(current: DataFrame, with_subproduct: bool, names: Sequence[str] | None = None) -> DataFrame:
    return by_store(current, with_subproduct, _only(CHURN_PROJ, names), CHURN_PROJ_NEEDS)


def churn_pct_projection_formulas(base: Sequence[str]) -> dict[str, Formula]:
    def gross(s: Sums) -> Column:
        return _total(s, _with_proj([PAID, DEF_PRINCIPAL])) - s(proj(ACTIVE_DELTA))

    def net(s: Sums) -> Column:
        return gross(s) - _total(s, _with_proj([REACTIVATED]))

    return {
        "Gross Churn Pct": lambda s: ratio(gross(s), _total(s, base)),
        "Net Churn Pct": lambda s: ratio(net(s), _total(s, base)),
    }


def churn_pct_projection(
    current: DataFrame,
    with_subproduct: bool,
    at_levels: Sequence[Level],
    base: Sequence[str],
    names: Sequence[str] | None = None,
) -> DataFrame:
    formulas = _only(churn_pct_projection_formulas(base), names)
    return by_level(current, with_subproduct, at_levels, formulas, CHURN_PROJ_NEEDS, name_tail=" Proj")


def ratio_projection(
    current: DataFrame,
    with_subproduct: bool,
    at_levels: Sequence[Level],
    counted: Sequence[str] = tuple(RATIOS),
) -> DataFrame:
    needed = sorted({*_with_proj(counted), *_with_proj([m for c in counted for m in RATIOS[c]])})
    formulas = ratio_projection_formulas(counted)
    return by_level(current, with_subproduct, at_levels, formulas, needed, name_tail=" Proj")


def closing_projection_formulas(with_current_delta: bool) -> dict[str, Formula]:
    """Calculated and expected closing counts.

    The first metric set adds the delta seen so far to the expected one; the second, whose
    closing counts of the current month are only month-to-date, adds the expected one alone.
    """

    def delta(s: Sums, metric: str) -> Column:
        return s(metric) + s(proj(metric)) if with_current_delta else s(proj(metric))

    def active_rest(s: Sums) -> Column:
        return -s(proj(DEF_PRINCIPAL)) - s(proj(PAID)) + s(proj(REACTIVATED)) + s(proj(NEW))

    def collections_rest(s: Sums) -> Column:
        return s(proj(DEF_ANY)) - s(proj(PAID_LATE)) - s(proj(CHARGED_OFF))

    return {
        "Active EOM Calculated Proj": active_rest,
        "Active EOM Proj": lambda s: _active_calc(s) + active_rest(s) + delta(s, ACTIVE_DELTA),
        "Collections EOM Calculated Proj": collections_rest,
        "Collections EOM Proj": lambda s: _collections_calc(s) + collections_rest(s) + delta(s, COLL_DELTA),
    }


CLOSING_NEEDS = [
    ACTIVE_BOM, COLL_BOM,
    *_with_proj([DEF_PRINCIPAL, PAID, REACTIVATED, NEW, DEF_ANY, PAID_LATE, CHARGED_OFF, ACTIVE_DELTA, COLL_DELTA]),
]


def closing_projection(
    current: DataFrame, with_subproduct: bool, with_current_delta: bool, names: Sequence[str] | None = None
) -> DataFrame:
    formulas = _only(closing_projection_formulas(with_current_delta), names)
    return by_store(current, with_subproduct, formulas, CLOSING_NEEDS)
