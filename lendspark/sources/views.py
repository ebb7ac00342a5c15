"""Application tables over the test tables: one application per order.

``applications`` and ``scored`` stand in for a lender's own tables; every other
function of the package takes whatever DataFrame it is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.functions.features import add_derived_features
from lendspark.functions.scalar import logistic
from lendspark.operators.history import with_history
from lendspark.operators.validate import TRAINING, valid_rows


#: Declared schemas of the test tables: no footer has to be read to plan a query.
TABLES = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


#: One application per order, in integer arithmetic wherever that is possible.
APPLICATION_COLUMNS = (
    "o_orderkey AS application_id",
    "o_custkey AS customer_id",
    "o_orderdate AS application_ts",
    "CAST(c_custkey % 63 + 18 AS INT) AS age",
    "round(c_acctbal * 1200D, 0) AS income",
    "CASE WHEN c_custkey % 29 <> 0 THEN CAST(c_custkey % 41 AS DOUBLE) / 2D END AS employment_years",
    """CASE WHEN c_custkey % 97 = 0 THEN 'PALACE' WHEN c_mktsegment = 'BUILDING' THEN 'OWN'
         WHEN c_mktsegment = 'FURNITURE' THEN 'MORTGAGE' WHEN c_mktsegment = 'MACHINERY' THEN 'OTHER'
         ELSE 'RENT' END AS home_ownership""",
    "o_totalprice AS loan_amount",
    "CASE WHEN o_orderkey % 37 <> 0 THEN CAST(o_orderkey % 180 AS DOUBLE) / 10D + 5D END AS interest_rate",
    "CASE o_orderkey % 3 WHEN 0 THEN 36 WHEN 1 THEN 60 END AS term_months",
    """elt(CAST(o_orderkey % 6 AS INT) + 1, 'PERSONAL', 'EDUCATION', 'MEDICAL', 'VENTURE',
         'HOMEIMPROVEMENT', 'DEBTCONSOLIDATION') AS loan_intent""",
    "elt(CAST(o_orderkey % 7 AS INT) + 1, 'A', 'B', 'C', 'D', 'E', 'F', 'G') AS loan_grade",
    "c_custkey % 30 + 1 AS credit_history_years",
    "CAST(o_orderkey % 101 AS DOUBLE) / 100D AS credit_utilization",
    "CAST(c_custkey % 5 = 0 AS INT) AS previous_defaults",
    """CAST(coalesce(n_returned, 0) >= 3 OR (o_totalprice > greatest(c_acctbal * 1200D, 1D) * 0.05D
         AND o_orderkey % 5 < 2) AS INT) AS loan_status""",
    "o_orderstatus = 'O' AS _open",
)


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    returned = (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("n_returned"))
    )
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        returned, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    return joined.selectExpr(*APPLICATION_COLUMNS)


def applications(spark: SparkSession, sf_dir: str, history: bool = True) -> DataFrame:
    """The applications view; without ``history`` the last three columns are left out."""
    base = _base(spark, sf_dir)
    if not history:
        return base.drop("_open")
    past = with_history(
        base,
        "customer_id",
        "application_ts",
        {
            "late_payments": "CAST(loan_status AS BIGINT)",
            "active_credit_lines": "CAST(_open AS BIGINT)",
            "total_debt": "CASE WHEN _open THEN CAST(loan_amount AS DECIMAL(14,2)) END",
        },
    )
    return past.selectExpr(
        *[c for c in base.columns if c != "_open"],
        "CAST(late_payments AS INT) AS late_payments",
        "CAST(active_credit_lines AS INT) AS active_credit_lines",
        "CAST(total_debt AS DOUBLE) AS total_debt",
    )


#: A fixed linear scorecard in log-odds: intercept, then (feature, centre, weight).
SCORECARD_INTERCEPT = -2.5
SCORECARD = (
    ("loan_to_income", 0.0, 1.5),
    ("interest_rate", 11.0, 0.05),
    ("late_payments", 0.0, 0.2),
    ("credit_utilization", 0.0, 0.5),
)


#: Scorecard inputs with their stand-ins for NULL.
SCORECARD_INPUTS = {
    "loan_to_income": "least(coalesce(loan_to_income, 1D), 1D)",
    "interest_rate": "coalesce(interest_rate, 11D)",
    "late_payments": "CAST(late_payments AS DOUBLE)",
    "credit_utilization": "credit_utilization",
}


def scorecard_inputs(df: DataFrame) -> DataFrame:
    """Add the scorecard's inputs as ``x_<feature>`` columns."""
    return df.withColumns({f"x_{n}": F.expr(sql) for n, sql in SCORECARD_INPUTS.items()})


def with_scorecard(df: DataFrame) -> DataFrame:
    """Add ``p``, the scorecard's probability to two decimals (so that ties occur)."""
    terms = "".join(f" + ({SCORECARD_INPUTS[n]} - {centre}D) * {w}D" for n, centre, w in SCORECARD)
    z = f"{SCORECARD_INTERCEPT}D{terms}"
    return add_derived_features(df).withColumn("p", F.expr(f"round({logistic(z)}, 2)"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applications valid under the training rules, with derived features and ``p``."""
    return with_scorecard(valid_rows(applications(spark, sf_dir), TRAINING))
