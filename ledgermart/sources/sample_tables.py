"""Credit-risk inputs derived from the sample order tables by fixed integer rules.

The rules of FIXTURES.md section 3, plus a second record twelve months later for every third
customer in ``attributes`` and ``financials`` so that "latest as of" has something to choose.
Every view is an expression over the whole tables, so its size follows theirs.  Orders are joined by sorting on
both sides: Spark guesses their size from compressed files, and a broadcast of what is guessed to be small
passes all orders through the driver, once per use of a view.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MODEL_VERSIONS = (
    "credit_model_logistic_regression_1999_01_01",
    "credit_model_random_forest_1999_01_01",
    "credit_model_xgboost_1999_01_01",
)
FIRST_MONTH = "1995-01-01"
LAST_MONTH = "2001-08-01"


def _customer_id(key: str) -> Column:
    return F.col(key).cast("string").alias("Customer_ID")


class SampleTables:
    """Lazily built input views for one data directory."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders").select(
            "o_orderkey",
            "o_custkey",
            "o_totalprice",
            F.to_date(F.trunc("o_orderdate", "MM")).alias("month"),
        )

    @cached_property
    def loans(self) -> DataFrame:
        """Loan ledger: one row per loan and installment."""
        lines = (
            self.table("lineitem")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(F.max("l_returnflag").alias("returned"), F.max("l_quantity").alias("quantity"))
        )
        key = F.col("l_orderkey")
        due = F.when(key % 97 == 0, 0).otherwise(100 + key % 9 * 25).cast("double")
        overdue = (
            F.when(F.col("returned") != "R", 0.0)
            .when(F.col("due_amt") == 0, 5.0)
            .otherwise(F.col("due_amt") * (F.col("quantity").cast("bigint") % 4))
        )
        number = F.col("l_linenumber")
        return (
            lines.join(self.orders.hint("merge"), key == F.col("o_orderkey"))
            .withColumn("due_amt", due)
            .withColumn("overdue_amt", overdue)
            .select(
                key.cast("string").alias("loan_id"),
                _customer_id("o_custkey"),
                F.col("month").alias("loan_start_date"),
                F.lit(10).alias("tenure"),
                number.alias("installment_num"),
                F.col("o_totalprice").alias("loan_amt"),
                "due_amt",
                F.greatest(F.col("due_amt") - F.col("overdue_amt"), F.lit(0.0)).alias("paid_amt"),
                "overdue_amt",
                (F.col("o_totalprice") * (1 - number / F.lit(10.0))).alias("balance"),
                F.add_months("month", number).alias("snapshot_date"),
            )
        )

    @cached_property
    def clickstream(self) -> DataFrame:
        """Behaviour: one row per customer and month of activity."""
        per_order = (
            self.table("lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.sum("l_quantity").alias("quantity"),
                F.count("*").alias("lines"),
                F.max("l_discount").alias("discount"),
                F.max("l_linenumber").alias("number"),
            )
        )
        return (
            per_order.join(self.orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("o_custkey", "month")
            .agg(
                F.sum("quantity").alias("fe_1"),
                F.sum("lines").alias("fe_2"),
                (F.max("discount") * 100).alias("fe_3"),
                F.max("number").alias("fe_4"),
            )
            .select(
                _customer_id("o_custkey"),
                F.col("month").alias("snapshot_date"),
                "fe_1",
                "fe_2",
                "fe_3",
                F.when(F.col("o_custkey") % 11 != 0, F.col("fe_4")).alias("fe_4"),
            )
        )

    @property
    def _revised_customers(self) -> DataFrame:
        revisions = F.when(F.col("c_custkey") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0))
        )
        return self.table("customer").select(
            F.col("c_custkey").alias("key"),
            "c_acctbal",
            "c_mktsegment",
            F.explode(revisions).alias("revision"),
        )

    @property
    def _record_date(self) -> Column:
        months = (F.col("key") % 60 + F.col("revision") * 12).cast("int")
        return F.add_months(F.lit(FIRST_MONTH).cast("date"), months).alias("snapshot_date")

    @cached_property
    def attributes(self) -> DataFrame:
        """Demographics: one row per customer and record date."""
        key = F.col("key")
        age = (18 + key % 73 + F.col("revision")).cast("string")
        jobs = F.create_map(
            *[
                F.lit(x)
                for x in (
                    "AUTOMOBILE", "Mechanic", "BUILDING", "Architect", "FURNITURE", "Teacher",
                    "HOUSEHOLD", "Writer", "MACHINERY", "Developer",
                )
            ]
        )
        return self._revised_customers.select(
            _customer_id("key"),
            F.when(key % 61 == 0, None)
            .when(key % 50 == 7, "-500")
            .when(key % 20 == 0, F.concat(age, F.lit("_")))
            .otherwise(age)
            .alias("Age"),
            F.when(key % 18 == 0, "#F%$D@*&8")
            .otherwise(
                F.concat_ws(
                    "-",
                    F.lpad((key % 1000).cast("string"), 3, "0"),
                    F.lpad((key % 100).cast("string"), 2, "0"),
                    F.lpad((key % 10000).cast("string"), 4, "0"),
                )
            )
            .alias("SSN"),
            F.when((key + F.col("revision")) % 14 == 0, "_______")
            .otherwise(jobs[F.col("c_mktsegment")])
            .alias("Occupation"),
            self._record_date,
        )

    @cached_property
    def financials(self) -> DataFrame:
        """Finances: one row per customer and record date."""
        order_counts = self.table("orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
        key = F.col("key")
        amount = F.floor(F.abs("c_acctbal")) + F.col("revision") * 100

        def text(c: Column) -> Column:
            return c.cast("string")

        def marked(c: Column, condition: Column) -> Column:
            return F.when(condition, F.concat(text(c), F.lit("_"))).otherwise(text(c))

        history = F.concat(text(key % 12), F.lit(" Months"))
        segment = F.lower("c_mktsegment")
        people = self._revised_customers.join(
            order_counts.hint("merge"), F.col("key") == F.col("o_custkey"), "left"
        )
        return people.select(
            _customer_id("key"),
            F.when(key % 83 == 0, "0").otherwise(marked(amount * 10, key % 19 == 0)).alias("Annual_Income"),
            F.when(key % 37 == 0, 0).otherwise(amount).cast("double").alias("Monthly_Inhand_Salary"),
            F.when(key % 41 == 0, "-100")
            .otherwise(text(F.coalesce("orders", F.lit(0)) % 10))
            .alias("Num_of_Loan"),
            marked(key % 25, key % 23 == 0).alias("Num_of_Delayed_Payment"),
            text(amount * 7 % 5000).alias("Outstanding_Debt"),
            F.element_at(F.array(*map(F.lit, ("Good", "Standard", "Bad", "_"))), (key % 4 + 1).cast("int")).alias("Credit_Mix"),
            F.element_at(F.array(*map(F.lit, ("Yes", "No", "NM"))), (key % 3 + 1).cast("int")).alias("Payment_of_Min_Amount"),
            F.when(key % 29 == 0, None)
            .when(key % 31 == 0, history)
            .otherwise(F.concat(text(key % 30), F.lit(" Years and "), history))
            .alias("Credit_History_Age"),
            (20 + (key % 300) / F.lit(10.0)).alias("Credit_Utilization_Ratio"),
            (key % 60).cast("int").alias("Delay_from_due_date"),
            (key % 500).cast("double").alias("Total_EMI_per_month"),
            (key % 700).cast("double").alias("Amount_invested_monthly"),
            (key % 900).cast("double").alias("Monthly_Balance"),
            F.when(key % 7 == 0, "")
            .when(key % 7 == 1, "_")
            .when(key % 7 == 2, F.concat(F.lit(" "), F.upper(segment), F.lit(" ")))
            .when(key % 7 == 3, "Not Specified")
            .when(key % 7 == 4, None)
            .when(key % 7 == 5, "home-equity loan")
            .otherwise(F.concat(segment, F.lit(" loan")))
            .alias("Type_of_Loan"),
            self._record_date,
        )

    @cached_property
    def predictions(self) -> DataFrame:
        """Scores of three model versions for every loan at its sixth installment."""
        versions = F.posexplode(F.array(*map(F.lit, MODEL_VERSIONS))).alias("version", "model_version")
        scored = self.loans.where("installment_num = 6").select("*", versions)
        score = (F.col("loan_id").cast("bigint") * 7919 + F.col("version") * 31) % 10007
        return scored.withColumn("proba", score / F.lit(10006.0)).select(
            "Customer_ID",
            "loan_id",
            F.col("snapshot_date").alias("feature_snapshot_date"),
            F.col("snapshot_date").cast("string").alias("snapshot_date"),
            "model_version",
            F.col("proba").alias("model_prediction_proba"),
            (F.col("proba") >= 0.5).cast("int").alias("model_prediction_binary"),
        )
