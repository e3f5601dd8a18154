"""Column rules about loans and amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status codes that never count as a granted loan, and the shorter
# list used when asking whether a loan was renewed.
NOT_GRANTED = ["I", "V", "W", "G", ""]
NOT_A_RENEWAL = ["I", "V", "W", ""]

# Products, the split of one product by its finance-charge rate, and the
# product name given to customers who hold small loans only.
ZIP = "Zip"
POCKET = "Pocket Money"
MINI = "Mini Money"
THURLOW = "Thurlow"
ZIP_30 = "Zip 30"
ZIP_FLEX = "Zip Flex"
ZIP_30_RATE = "0.21"
MINI_ONLY = "Mini Money Only"

# Three decimals, as the metrics are rounded; wide enough for any count.
METRIC_VALUE = "decimal(21,3)"
MONEY = "decimal(19,4)"


def granted(status: str | Column = "Loan_Status") -> Column:
    col = F.col(status) if isinstance(status, str) else status
    return ~col.isin(NOT_GRANTED)


def subproduct(product: Column, charge: Column, amount: Column) -> Column:
    """Zip loans split by finance-charge rate; a zero amount has no rate and is Flex."""
    rate = F.try_divide(charge, amount)
    return F.when(
        product == ZIP, F.when(rate >= F.lit(ZIP_30_RATE).cast("decimal(3,2)"), ZIP_30).otherwise(ZIP_FLEX)
    ).otherwise(product)


def looked_up(code: Column, values: dict[str, int] | dict[str, str]) -> Column:
    """The value listed for a code, NULL for other codes."""
    pairs = ", ".join(f"'{k}', {v!r}" for k, v in values.items())
    return F.element_at(F.expr(f"map({pairs})"), code)


def zero_if_null(col: Column, kind: str = MONEY) -> Column:
    return F.coalesce(col, F.lit(0)).cast(kind)


def cso_share(paid: Column, charge: Column, fee: Column) -> Column:
    """The part of a paid finance charge that belongs to a fee component.

    A payment that covers the whole charge takes the whole fee, a partial one its share
    rounded to cents. The test order matters: a full reversal ends in the last share case,
    because the third case needs a charge below zero.
    """
    paid, charge, fee = zero_if_null(paid), zero_if_null(charge), zero_if_null(fee)
    share = _share(paid, charge, fee)
    return (
        F.when((paid > 0) & (paid >= charge), fee)
        .when((paid > 0) & (paid < charge), share)
        .when((paid < 0) & (paid >= charge), -fee)
        .when((paid < 0) & (paid < charge) & (charge != 0), share)
        .otherwise(F.lit(0))
        .cast(MONEY)
    )


def _share(paid: Column, charge: Column, fee: Column) -> Column:
    """paid * fee / charge in cents, halves away from zero; NULL for a charge of zero.

    Done in whole ten-thousandths, so that the product keeps every digit of two money amounts.
    """
    top, bottom = _units(paid) * _units(fee), _units(charge) * 100
    cents = F.call_function("div", F.abs(top) * 2 + F.abs(bottom), F.nullif(F.abs(bottom) * 2, F.lit(0)))
    return (cents * F.signum(top).cast("int") * F.signum(bottom).cast("int")).cast("decimal(19,0)") * F.lit("0.01").cast(
        "decimal(2,2)"
    )


def _units(amount: Column) -> Column:
    return (amount * 10000).cast("decimal(19,0)")


def ratio(top: Column, bottom: Column) -> Column:
    """A metric ratio: NULL over zero, seven digits in between, stored with three."""
    return F.try_divide(top, bottom).cast("decimal(28,7)").cast(METRIC_VALUE)
