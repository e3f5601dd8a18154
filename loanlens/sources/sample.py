"""Loan tables derived from the sample order tables.

The sample data has customers, orders and order lines; here they play borrowers, loans and
payments. Every rule is plain column arithmetic, so the same table can be derived in any SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loanlens.functions.loan import looked_up
from loanlens.session import written

# The product sold by store number 0..3 of each nation.
STORE_PRODUCTS = ["Zip", "Pocket Money", "Mini Money", "Thurlow"]

# Payment type by return flag and line status.
PAYMENT_TYPES = {"RF": "N", "RO": "P", "AF": "S", "AO": "R", "NF": "X", "NO": "B"}


def padded(col: Column, width: int) -> Column:
    return F.lpad(col.cast("string"), width, "0")


def day(col: Column) -> Column:
    return col.cast("date")


def at_time(col: Column, hour: int, minute: int) -> Column:
    """A date as date-time with a fixed time of day."""
    clock = F.lit(f" {hour:02d}:{minute:02d}:00")
    return F.concat(F.date_format(col, "yyyy-MM-dd"), clock).cast("timestamp_ntz")


def money(col: Column) -> Column:
    return col.cast("decimal(12,2)")


def pick(index: Column, values: list) -> Column:
    """The value at position `index` (from 0) of a fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


class SampleTables:
    """The loan tables of one sample folder, each built on first use of its method."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- loan side -----------------------------------------------------------------

    def dim_merchant(self) -> DataFrame:
        nation, region = self.raw("nation"), self.raw("region")
        n = F.col("n_nationkey")
        i = F.col("i")
        return (
            nation.join(region, nation.n_regionkey == region.r_regionkey)
            .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(3))))
            .select(
                F.concat(padded(n, 5), padded(i, 6)).alias("Merchant_Store_Id"),
                F.when((i == 3) & (n % 5 == 0), None).otherwise(pick(i, STORE_PRODUCTS)).alias("Product"),
                F.when(F.col("r_regionkey") % 2 == 0, "Online").otherwise("Retail").alias("Business_Unit"),
                F.concat(F.lit("R"), F.col("r_regionkey")).alias("Region"),
                F.concat(F.lit("P"), n).alias("Province_State"),
                F.concat(F.col("n_name"), F.lit(" "), i).alias("Store"),
            )
        )

    def with_customer(self, orders: DataFrame) -> DataFrame:
        customer = self.raw("customer")
        return orders.join(
            customer.select("c_custkey", "c_nationkey"), orders.o_custkey == customer.c_custkey
        )

    def previous_orders(self, asked: Column | None = None) -> DataFrame:
        """Order key -> the customer's previous order by date and key; of the `asked` orders (all).

        Two steps, so that a customer with very many orders is spread over its days: the
        previous order of the same day, or else the last order of the last earlier day. Both read one shuffle of the orders.
        """
        opened = day(F.col("o_orderdate"))
        # Orders without a date come before all days, and have no previous order themselves.
        number = F.coalesce(F.unix_date(opened), F.lit(-(2**31)))
        orders = self.raw("orders").filter("o_custkey IS NOT NULL")
        orders = orders.select("o_custkey", "o_orderkey", number.alias("d"), opened.isNotNull().alias("dated"))
        orders = orders.repartition("o_custkey", "d")
        within_day = W.partitionBy("o_custkey", "d").orderBy("o_orderkey")
        over_days = W.partitionBy("o_custkey").orderBy("d")
        asked = F.col("dated") if asked is None else F.col("dated") & asked
        last_of_day = (
            orders.groupBy("o_custkey", "d")
            .agg(F.max("o_orderkey").alias("last_key"), F.max(asked).alias("asked"))
            .select("o_custkey", "d", F.lag("last_key").over(over_days).alias("earlier_key"), "asked")
            .filter("asked")
            .drop("asked")
        )
        return (
            orders.withColumn("same_day_key", F.lag("o_orderkey").over(within_day))
            .filter(asked)
            .join(last_of_day, ["o_custkey", "d"])
            .select("o_orderkey", F.coalesce("same_day_key", "earlier_key").alias("previous_key"))
        )

    def _repeated_orders(self) -> DataFrame:
        """Order numbers that come more than once, and how often."""
        orders = self.raw("orders").filter("o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND o_orderdate IS NOT NULL")
        counted = orders.groupBy(F.col("o_orderkey").alias("repeated_no")).agg(F.count("*").cast("int").alias("times"))
        return counted.filter("times > 1")

    def repeated_orders(self) -> DataFrame:
        """They are stored, so that few of them need no shuffle of what they meet."""
        return written(self._repeated_orders(), "repeated_orders")

    def met_as_often(self, rows: DataFrame, number: str) -> DataFrame:
        """Every row as often as orders have its number: what a join with all rows of that number gives."""
        met = rows.join(self.repeated_orders(), F.col(number) == F.col("repeated_no"), "left")
        each = F.explode(F.array_repeat(F.lit(1), F.coalesce("times", F.lit(1))))
        return met.withColumn("each", each).select(*rows.columns)

    def loan_appl(self, with_renewals: bool = True) -> DataFrame:
        k = F.col("o_orderkey")
        rank = F.substring("o_orderpriority", 1, 1)
        opened = day(F.col("o_orderdate"))
        status = (
            F.when(F.col("o_orderstatus") == "O", F.when(rank == "1", "N").otherwise("O"))
            .when(F.col("o_orderstatus") == "F", F.when(rank.isin("1", "2"), "P").otherwise("D"))
            .otherwise(F.when(rank == "2", "C").when(rank == "3", "B").when(rank == "4", "V").otherwise("R"))
        )
        kind = F.when(k % 5 == 0, "R").otherwise("S")
        amount = money(F.col("o_totalprice"))
        rate = (F.lit(155) + F.lit(10) * (k % 10)).cast("decimal(6,0)") * F.lit("0.001").cast("decimal(4,3)")
        # A date and a status of one character go into the joins, not the four texts and times that they come from.
        orders = self.raw("orders").select(
            "o_orderkey", "o_custkey", "o_totalprice", opened.alias("opened"), status.alias("status")
        )
        opened, status = F.col("opened"), F.col("status")
        orders = self.with_customer(orders)
        if with_renewals:
            # The orders are joined almost as they are read: the loans made from them are twice as wide. Only
            # renewals meet the previous order; a repeated number meets each of its rows, whatever its kind.
            renews = F.coalesce(kind == "R", F.lit(False))
            links = self.previous_orders(renews).withColumnRenamed("o_orderkey", "renewing_key")
            linked = orders.filter(renews).join(links, k == F.col("renewing_key"), "left").drop("renewing_key")
            alone = self.met_as_often(orders.filter(~renews), "o_orderkey")
            orders = linked.unionByName(alone.withColumn("previous_key", F.lit(None).cast("bigint")))
        renewed = [F.when(kind == "R", F.col("previous_key")).alias("Ren_ApplNo")] if with_renewals else []
        return orders.select(
            k.alias("Appl_No"),
            F.concat(padded(F.col("c_nationkey"), 5), padded(k % 4, 6)).alias("Merch_Store_Id"),
            F.col("o_custkey").alias("Cust_Id"),
            F.concat(F.lit("9"), padded(F.col("o_custkey"), 8)).alias("Cust_SSN"),
            opened.alias("Origin_Date"),
            F.date_add(opened, (F.lit(14) + k % 17).cast("int")).alias("Req_Due_Date"),
            status.alias("Loan_Status"),
            kind.alias("Loan_Type"),
            amount.alias("Req_Loan_Amt"),
            (amount * rate).alias("Fin_Charge"),
            F.date_add(opened, (F.lit(20) + k % 40).cast("int")).alias("LastPmtDate"),
            F.date_add(opened, (F.lit(10) + k % 80).cast("int")).alias("Last_Modified"),
            *renewed,
        )

    def payment(self) -> DataFrame:
        principle = F.when(F.col("l_linenumber") % 3 == 0, F.lit(0)).otherwise(F.col("l_quantity")).cast("decimal(12,2)")
        lines = self.raw("lineitem").select(
            "l_orderkey", "l_linenumber", payment_type().alias("Pmt_Type"), principle.alias("Principle_Paid")
        )
        orders = self.raw("orders").select("o_orderkey", "o_orderdate")
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
            F.col("l_orderkey").alias("Appl_No"),
            F.date_add(day(F.col("o_orderdate")), F.lit(7) * F.col("l_linenumber")).alias("Pmt_Date"),
            "Pmt_Type",
            "Principle_Paid",
        )


def payment_type() -> Column:
    flags = F.concat("l_returnflag", "l_linestatus")
    return looked_up(flags, PAYMENT_TYPES)
