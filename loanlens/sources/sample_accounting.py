"""Accounting tables derived from the sample order tables, in the same way as the loan tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loanlens.functions.loan import MONEY
from loanlens.sources.sample import SampleTables, at_time, money, padded, payment_type, pick

# Payment types that the order flags do not give, one per part number modulo 24.
RARE_PAYMENT_TYPES = ["Y", "9", "U", "W", "G", "K", "Q", "6", "E", "A", "1", "H"]
HISTORY_STATUSES = ["N", "O", "R", "C", "B", "G", "D"]
GL_TYPES = [
    1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 16, 20, 21, 22, 23, 24, 25, 27, 28, 29, 30,
    80, 82, 84, 85, 87, 89, 90, 92, 95, 96,
]
EVENT_SHIFT_DAYS = 8766  # events move back 24 years, into the years of the loans


def as_money(col: Column) -> Column:
    return col.cast(MONEY)


def text(prefix: str, col: Column) -> Column:
    return F.concat(F.lit(prefix), col.cast("string"))


class SampleBooks:
    """The source tables of the accounting extract, each built when it is first read."""

    NAMES = {
        "loans": "ca_loan_appl", "customers": "ca_customer", "users": "ca_user", "collections": "ca_collections",
        "rates": "ca_ratemaster", "ach": "ca_ach_processed", "ach_returns": "ca_achreturns",
        "payments": "ca_payment", "voids": "ca_void", "fee_details": "ca_feechargedetails",
        "interest": "ca_interest_calc", "charges": "ca_bankruptcy_charges", "history": "ca_loanapplicationhistory",
        "petty_cash": "ca_pettycashtransaction", "balances": "ca_balance", "cash": "ca_cash",
        "checks": "ca_checks", "gl_codes": "ca_merchant_glcodes",
    }

    def __init__(self, sample: AccountingSample):
        self._sample = sample

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise AttributeError(name)
        table = getattr(self._sample, self.NAMES[name])()
        setattr(self, name, table)
        return table


class AccountingSample(SampleTables):
    def tables(self) -> SampleBooks:
        return SampleBooks(self)

    def ca_loan_appl(self) -> DataFrame:
        k = F.col("Appl_No")
        nation = F.substring("Merch_Store_Id", 1, 5).cast("bigint")
        return self.loan_appl(with_renewals=False).select(
            "Appl_No", "Merch_Store_Id", "Cust_Id", "Cust_SSN", "Req_Due_Date", "Loan_Status", "Loan_Type",
            "Req_Loan_Amt", "Fin_Charge", "Last_Modified",
            F.when(k % 13 != 0, F.col("Origin_Date")).alias("Origin_Date"),
            F.when(k % 17 == 0, "P").otherwise("A").alias("Appl_Status"),
            at_time(F.col("Origin_Date"), 9, 30).alias("Date_Created"),
            text("U", k % 3).alias("User_Id"),
            text("U", k % 4).alias("origin_user"),
            pick(k % 3, ["C", "K", "A"]).alias("Disb_Mode"),
            (k % 3).cast("int").alias("Cashdisbmode"),
            text("CK", k).alias("PrintedCheckNo"),
            (nation * 6 + k % 6).alias("RateID"),
        )

    def ca_customer(self) -> DataFrame:
        k = F.col("c_custkey")
        name = F.split("c_name", "#")
        return self.raw("customer").select(
            k.alias("Cust_Id"),
            padded(F.col("c_nationkey"), 5).alias("Cust_MerchantID"),
            name[0].alias("Cust_Fname"),
            F.when(k % 3 != 0, text("M", k % 10)).alias("Cust_MName"),
            name[1].alias("Cust_Lname"),
            text("S", F.col("c_nationkey") % 10).alias("Cust_State"),
            F.concat(F.lit("9"), padded(k, 8)).alias("Cust_SSN"),
        )

    def ca_user(self) -> DataFrame:
        merchant = padded(F.col("n_nationkey"), 5)
        return (
            self.raw("nation")
            .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(2))))
            .select(
                merchant.alias("Merch_Id"),
                text("U", F.col("i")).alias("User_Id"),
                F.concat(merchant, F.lit("-U"), F.col("i")).alias("Merchant_Userid"),
            )
        )

    def ca_ratemaster(self) -> DataFrame:
        n, j = F.col("n_nationkey").cast("bigint"), F.col("j")
        return (
            self.raw("nation")
            .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(5))))
            .select(
                (n * 6 + j).alias("RateID"),
                F.concat(padded(n, 5), F.lit("000000")).alias("StoreID"),
                (j % 2 == 1).alias("CSOType"),
                as_money(F.lit(10) + j * F.lit("2.50").cast("decimal(4,2)")).alias("Origination_Fee"),
                as_money(F.lit(4) + j).alias("Interest_Fee"),
                as_money(pick(j, [0, 2000, 0, 5000, 0, 0])).alias("FinCharge"),
            )
        )

    def ca_payment(self) -> DataFrame:
        """Payments with a number that is unique without a global sort.

        Lines of a loan are numbered inside 64 small buckets; number and bucket together give the id (room for
        ten million payments per loan). The lines are shuffled once, by loan, for the join with their loans; the
        numbering finds them there. Where that join splits a loan with very many payments, the numbering is
        shuffled by bucket instead.
        """
        line, part = F.col("l_linenumber"), F.col("l_partkey")
        bucket = line + 8 * (part % 8)
        inside = W.partitionBy("l_orderkey", "l_linenumber", "bucket").orderBy(
            "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate"
        )
        rare = part % 24
        kind = F.when(rare < 12, pick(F.least(rare, F.lit(11)), RARE_PAYMENT_TYPES)).otherwise(payment_type())
        sign = F.when(part % 11 == 0, -1).otherwise(1)
        lines = self.raw("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
            "l_shipdate", kind.alias("Pmt_Type"),
        )
        loans = self._loans_with_lines()
        # One row per loan number, so that a number that the orders repeat does not repeat its lines before they are counted.
        # A returned payment refers to the payment with the line number before it: the first one of its lowest bucket.
        before = F.array_min(F.filter("lows", lambda c: (c >= (line - 1) * 16) & (c < line * 16)))
        low = before - (line - 1) * 16 - 8
        before_no = F.col("l_orderkey") * 10_000_000 + 64 + (line - 1) + 8 * low
        numbered = (
            lines.join(loans, lines.l_orderkey == loans.Appl_No)
            .select("*", bucket.alias("bucket"), F.when(F.col("Pmt_Type") == "N", before_no).alias("Refno"))
            .drop("lows")
            .withColumn("n", F.row_number().over(inside))
        )
        paid_on = F.date_add("granted_on", 7 * line)
        rows = (
            numbered.select("*", F.explode("loans").alias("loan"))
            .select("*", "loan.*")
            .withColumn("blank", F.col("Pmt_Type").isin("Y", "9") & (line % 2 == 0))
        )
        zero = F.lit(0)

        def unless_blank(col: Column) -> Column:
            return as_money(F.when(F.col("blank"), zero).otherwise(col))

        price, discount = money(F.col("l_extendedprice")), F.col("l_discount").cast("decimal(4,2)")
        return rows.select(
            (F.col("l_orderkey") * 10_000_000 + F.col("n") * 64 + F.col("bucket")).alias("Pmt_Tran_No"),
            "Appl_No",
            F.concat("merchant", padded(F.col("l_suppkey") % 4, 6)).alias("Merch_Store_Id"),
            at_time(paid_on, 11, 0).alias("Pmt_Date"),
            at_time(paid_on, 11, 0).alias("Date_Created"),
            "Pmt_Type",
            F.when(F.col("l_suppkey") % 5 != 4, pick(F.col("l_suppkey") % 5 % 4, ["C", "K", "A", "G"])).alias("Pmt_Mode"),
            as_money(price).alias("Pmt_Amt"),
            unless_blank(F.when(line % 3 == 0, zero).otherwise(F.col("l_quantity").cast("decimal(12,2)")) * sign).alias(
                "Principle_Paid"
            ),
            F.when(line != 7, unless_blank(price * discount * sign)).alias("Fincharge_Paid"),
            unless_blank(F.col("l_tax").cast("decimal(4,2)") * 100).alias("latecharge_Paid"),
            F.when(line % 4 != 0, as_money(zero)).alias("Othcharge_Paid"),
            unless_blank((line % 2) * 5).alias("Feecharge_Paid"),
            (line % 3).cast("int").alias("Misintfield1"),
            "Refno",
        )

    def _loans_with_lines(self) -> DataFrame:
        """Per loan number the loans (one, unless the orders repeat it) and the buckets of its lines, as line * 16 + 8 + part % 8.

        The rows are gathered by one column more than they are joined by: the join then shuffles them itself and
        can split a loan with a large part of the lines.
        """
        granted = F.struct(
            F.substring("Merch_Store_Id", 1, 5).alias("merchant"), F.col("Date_Created").cast("date").alias("granted_on")
        )
        loans = self.ca_loan_appl().select("Appl_No", granted.alias("loan"), F.lit(None).cast("bigint").alias("low"))
        lows = self.raw("lineitem").select(
            F.col("l_orderkey").alias("Appl_No"),
            F.lit(None).cast(loans.schema["loan"].dataType).alias("loan"),
            (F.col("l_linenumber").cast("bigint") * 16 + 8 + F.col("l_partkey") % 8).alias("low"),
        )
        spread = F.pmod(F.hash("Appl_No"), F.lit(1)).alias("spread")
        gathered = loans.unionByName(lows).filter("Appl_No IS NOT NULL").groupBy("Appl_No", spread)
        return gathered.agg(F.collect_list("loan").alias("loans"), F.collect_set("low").alias("lows")).drop("spread")

    def ca_void(self) -> DataFrame:
        k = F.col("Appl_No")
        return self.ca_loan_appl().filter(F.col("Loan_Status") == "V").select(
            (k * 10 + 1).alias("Void_Id"),
            k.alias("Void_No"),
            F.when(k % 7 == 0, "P").otherwise("L").alias("Void_Type"),
            at_time(F.col("Last_Modified"), 13, 20).alias("Date_Created"),
        )

    def ca_feechargedetails(self) -> DataFrame:
        line = F.col("l_linenumber")
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("Appl_No"),
            pick(line % 4, ["B", "F", "L", "X"]).alias("Feetypecode"),
            F.when(line != 5, as_money(F.col("l_tax").cast("decimal(4,2)") * 100)).alias("Amount"),
        )

    def ca_bankruptcy_charges(self) -> DataFrame:
        k = F.col("Appl_No")
        return self.ca_loan_appl().filter(F.col("Loan_Status").isin("B", "C")).select(
            (k * 10 + 2).alias("Bc_No"),
            k.alias("Appl_No"),
            F.col("Loan_Status").alias("Bc_Flag"),
            as_money(F.col("Req_Loan_Amt")).alias("Prinamt"),
            as_money(F.when(k % 5 == 0, -as_money(F.col("Fin_Charge"))).otherwise(as_money(F.col("Fin_Charge")))).alias(
                "Finamt"
            ),
            F.when(k % 3 != 0, as_money(F.lit("12.50").cast("decimal(4,2)") + k % 7)).alias("Feeamt"),
            at_time(F.col("Last_Modified"), 16, 45).alias("Date_Created"),
        )

    def ca_loanapplicationhistory(self) -> DataFrame:
        k = F.col("Appl_No")
        old = pick(k % 7, HISTORY_STATUSES)
        amount = as_money(F.col("Req_Loan_Amt"))
        return self.ca_loan_appl().select(
            k.alias("ApplNo"),
            old.alias("oldloanstatus"),
            F.when(k % 2 == 0, old).otherwise(pick((k * 3 + 1) % 7, HISTORY_STATUSES)).alias("newloanstatus"),
            F.when(k % 9 == 0, "2").otherwise("1").alias("recordstatusid"),
            amount.alias("oldprinciplebalance"),
            as_money(amount + (k % 3 - 1) * 50).alias("newprinciplebalance"),
            as_money((k % 5) * 10).alias("oldfinchgbalance"),
            as_money((k % 7) * 10).alias("newfinchgbalance"),
            as_money((k % 2) * 5).alias("oldfeebalance"),
            as_money((k % 3) * 5).alias("newfeebalance"),
            at_time(F.col("Last_Modified"), 12, 15).alias("DateCreated"),
        )

    def ca_ach_processed(self) -> DataFrame:
        k = F.col("Appl_No")
        granted = self.ca_loan_appl().filter(F.col("Disb_Mode") == "A").select(
            (k * 10 + 3).alias("ACH_No"),
            k.alias("Appl_No"),
            F.lit(None).cast("bigint").alias("Pmt_No"),
            F.col("Merch_Store_Id").alias("Store_No"),
            text("Borrower ", k).alias("Name"),
            F.lit("22").alias("Tran_Code"),
            F.lit("C").alias("ACH_For"),
            F.lit("SND").alias("ACH_Code"),
            F.when(k % 5 == 0, "F").otherwise("S").alias("ACH_Sent_Status"),
            at_time(F.date_add(F.col("Date_Created").cast("date"), 1), 8, 0).alias("ACH_Sent_Time"),
            as_money(F.col("Req_Loan_Amt")).alias("Ach_Amt"),
            (k % 11 == 0).alias("IsDeleted"),
        )
        purpose = pick(k % 4, ["B", "C", "M", "N"])
        paid = self.ca_payment().filter(F.col("Pmt_Mode") == "A").select(
            (F.col("Pmt_Tran_No") * 10 + 4).alias("ACH_No"),
            F.when(purpose != "N", k).alias("Appl_No"),
            F.col("Pmt_Tran_No").alias("Pmt_No"),
            F.col("Merch_Store_Id").alias("Store_No"),
            text("Payer ", k).alias("Name"),
            F.lit("27").alias("Tran_Code"),
            purpose.alias("ACH_For"),
            F.lit("SND").alias("ACH_Code"),
            F.lit("S").alias("ACH_Sent_Status"),
            at_time(F.date_add(F.col("Pmt_Date").cast("date"), 1), 10, 30).alias("ACH_Sent_Time"),
            F.col("Pmt_Amt").alias("Ach_Amt"),
            (F.col("Misintfield1") == 2).alias("IsDeleted"),
        )
        return granted.unionByName(paid)

    def ca_achreturns(self) -> DataFrame:
        number = F.col("Pmt_Tran_No") * 10 + 4
        returned = (F.col("Pmt_Mode") == "A") & F.col("Pmt_Type").isin("N", "P", "S")
        return self.ca_payment().filter(returned).select(
            (number * 10 + 1).alias("Achretid"), number.alias("Achno")
        )

    def ca_interest_calc(self) -> DataFrame:
        return self.ca_payment().filter(F.col("Pmt_Type").isin("R", "S")).select(
            "Pmt_Tran_No",
            F.when(F.col("Pmt_Type") == "R", "A").otherwise("W").alias("intcalc_Typecode"),
            as_money(F.col("latecharge_Paid") + F.lit("1.25").cast("decimal(4,2)")).alias("Amount"),
        )

    def ca_collections(self) -> DataFrame:
        return self.ca_loan_appl().filter(F.col("Loan_Status") == "R").select(
            "Appl_No",
            at_time(F.col("Last_Modified"), 9, 15).alias("PlacedIntoCollections"),
            text("COL", F.col("Appl_No") % 5).alias("Assigned_User_ID"),
        )

    def _events(self, kind: str) -> DataFrame:
        when = F.col("ts").cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(EVENT_SHIFT_DAYS))
        store = F.concat(padded(F.col("user_id") % 25, 5), padded(F.col("event_id") % 4, 6))
        return (
            self.raw("events")
            .filter(F.col("event_type") == kind)
            .select("event_id", "user_id", store.alias("store"), when.alias("at"), money(F.col("value")).alias("amount"))
        )

    def ca_pettycashtransaction(self) -> DataFrame:
        return self._events("click").select(
            F.col("event_id").alias("Pettycashtranid"),
            F.col("store").alias("Store_Id"),
            F.col("at").alias("Tran_Date"),
            as_money(F.col("amount")).alias("Tran_Amount"),
            text("T", F.col("user_id") % 9).alias("UserCreated"),
        )

    def ca_balance(self) -> DataFrame:
        over_short = (F.col("event_id") % 3 - 1) * F.lit("2.25").cast("decimal(4,2)")
        return self._events("view").select(
            F.col("event_id").alias("Balance_ID"),
            F.col("store").alias("Merch_Store_ID"),
            F.col("at").alias("Eff_Bal_Date"),
            text("T", F.col("user_id") % 9).alias("User_ID"),
            as_money(F.col("amount") - 5).alias("Actual_Deposit"),
            as_money(over_short).alias("TotOverShort"),
        )

    def ca_cash(self) -> DataFrame:
        return self._events("purchase").select(
            F.col("event_id").alias("CashSourceID"),
            F.col("store").alias("StoreID"),
            F.col("at").alias("DateCreated"),
            as_money(F.col("amount")).alias("Amount"),
            text("T", F.col("user_id") % 9).alias("UserCreated"),
        )

    def ca_checks(self) -> DataFrame:
        k = F.col("Appl_No")
        return self.ca_loan_appl().filter(F.col("Disb_Mode") == "K").select(
            F.when(F.col("Loan_Status") == "R", text("REF-", k)).otherwise(k.cast("string")).alias("CheckRefNo"),
            F.when(k % 5 == 0, "XX").otherwise(text("CK", k)).alias("CheckNo"),
            as_money(F.col("Req_Loan_Amt")).alias("CheckAmount"),
            as_money((1 + k % 3) * F.lit("2.50").cast("decimal(4,2)")).alias("FeeAmount"),
            (k % 5 + 1).alias("CheckTypeID"),
            F.col("Cust_Id").alias("CustID"),
            F.col("Merch_Store_Id").alias("StoreID"),
            at_time(F.date_add(F.col("Date_Created").cast("date"), 1), 14, 5).alias("DateCreated"),
            text("T", k % 6).alias("UserCreated"),
        )

    def ca_merchant_glcodes(self) -> DataFrame:
        kind, account = F.col("t"), F.col("a")
        code = F.concat(kind.cast("string"), F.lit("-"), account.cast("string"))
        return (
            self.raw("nation")
            .withColumn("t", F.explode(F.array(*[F.lit(t) for t in GL_TYPES])))
            .withColumn("a", F.explode(F.sequence(F.lit(1), F.lit(3))))
            .filter((kind + account) % 4 != 0)
            .select(
                padded(F.col("n_nationkey"), 5).alias("Merchant_ID"),
                kind.alias("Tran_Type_Id"),
                account.alias("Tran_Account"),
                F.concat(F.lit("D1-"), code).alias("GL_Code_Debit1"),
                F.when(kind % 2 == 0, F.concat(F.lit("D2-"), code)).alias("GL_Code_Debit2"),
                F.concat(F.lit("C1-"), code).alias("GL_Code_Credit1"),
                F.when(account == 2, F.concat(F.lit("C2-"), code)).alias("GL_Code_Credit2"),
            )
        )
