"""The three raw sources, played by the shared sample tables.

Every adapter keeps all rows of its table. Values are made untidy on purpose
(case, spaces, an unknown segment and currency) so that staging has work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Market segment to the raw text of a customer segment.
SEGMENT_TEXT = {
    "AUTOMOBILE": " free",
    "BUILDING": "PRO",
    "FURNITURE": "Business",
    "HOUSEHOLD": "enterprise ",
    "MACHINERY": "machinery",
}
# Nation number modulo 5 to the raw text of an acquisition channel.
CHANNEL_TEXT = {0: "Organic ", 1: "paid_search", 2: " PAID_SOCIAL", 3: "referral", 4: "Direct"}
# Order status to the raw text of a payment status.
STATUS_TEXT = {"F": "Succeeded ", "O": "FAILED", "P": "refunded"}
# Order priority to the raw text of a currency; large orders are in a currency without a rate.
CURRENCY_TEXT = {
    "1-URGENT": "USD",
    "2-HIGH": "eur ",
    "3-MEDIUM": "GBP",
    "4-NOT SPECIFIED": " inr",
    "5-LOW": "Jpy",
}
UNRATED_CURRENCY = "CHF"
UNRATED_FROM = 480_000


def _lookup(key: str, words: dict) -> str:
    """SQL text of a fixed lookup."""
    pairs = " ".join(f"WHEN {value!r} THEN {word!r}" for value, word in words.items())
    return f"CASE {key} {pairs} END"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A sample table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers; the signup is the first order."""
    first_order = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("signup_date"))
    )
    balance = F.col("c_acctbal")
    return (
        table(spark, folder, "customer")
        .join(first_order, F.col("c_custkey") == F.col("o_custkey"), "left")
        .selectExpr(
            "cast(c_custkey AS string) AS customer_id",
            "concat(' ', split_part(c_name, '#', 1)) AS first_name",
            "concat(split_part(c_name, '#', 2), '  ') AS last_name",
            "concat(c_name, '@Example.COM ') AS email",
            "signup_date",
            "concat(' n', c_nationkey) AS country",
            f"{_lookup('c_nationkey % 5', CHANNEL_TEXT)} AS acquisition_channel",
            f"{_lookup('c_mktsegment', SEGMENT_TEXT)} AS segment",
            "CASE WHEN c_acctbal > 5000 THEN 'True' WHEN c_acctbal > 2500 THEN '1'"
            " WHEN c_acctbal > 0 THEN 't' ELSE 'no' END AS is_active",
        )
    )


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """App events; kind and value decide the type, so some users never reach a step."""
    return table(spark, folder, "events").selectExpr(
        "cast(event_id AS string) AS event_id",
        "cast(user_id AS string) AS customer_id",
        "ts AS event_timestamp",
        "CASE WHEN event_type = 'view' THEN ' Page_View'"
        " WHEN event_type = 'click' AND value > 100 THEN 'SIGN_UP_STARTED'"
        " WHEN event_type = 'signup' AND value > 110 THEN 'sign_up_completed '"
        " WHEN event_type = 'purchase' AND value > 150 THEN 'Upgraded'"
        " WHEN event_type = 'purchase' AND value > 80 THEN 'activated'"
        " WHEN event_type = 'error' THEN 'churned'"
        " ELSE 'feature_used' END AS event_type",
        "CASE WHEN value < 30 THEN 'Web ' WHEN value < 60 THEN ' iOS' ELSE 'ANDROID' END"
        " AS platform",
        "CASE WHEN user_id IS NOT NULL THEN format_string('S%08d', user_id) END AS session_id",
    )


def raw_payments(spark: SparkSession, folder: str) -> DataFrame:
    """Payments; one per order."""
    return table(spark, folder, "orders").selectExpr(
        "cast(o_orderkey AS string) AS payment_id",
        "cast(o_custkey AS string) AS customer_id",
        "o_orderdate AS payment_timestamp",
        "o_totalprice AS amount",
        f"CASE WHEN o_totalprice >= {UNRATED_FROM} THEN '{UNRATED_CURRENCY}'"
        f" ELSE {_lookup('o_orderpriority', CURRENCY_TEXT)} END AS currency",
        f"{_lookup('o_orderstatus', STATUS_TEXT)} AS status",
        "substr(o_orderpriority, 3) AS plan",
    )


# Order numbers that these divide have an amount or a time that is none.
NO_AMOUNT, AMOUNT_WITH_UNIT, NO_SUCH_DAY, EMPTY_TIME = 41, 43, 47, 53


def payment_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Payments as an extract's texts, some of them without a typed value; one per order."""
    price = "cast(cast(o_totalprice AS decimal(12,2)) AS string)"
    return table(spark, folder, "orders").selectExpr(
        "cast(o_orderkey AS string) AS payment_id",
        f"CASE WHEN o_orderkey % {NO_SUCH_DAY} = 0 THEN '2024-13-45'"
        f" WHEN o_orderkey % {EMPTY_TIME} = 0 THEN ''"
        " ELSE date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') END AS payment_timestamp",
        f"CASE WHEN o_orderkey % {NO_AMOUNT} = 0 THEN 'n/a'"
        f" WHEN o_orderkey % {AMOUNT_WITH_UNIT} = 0 THEN concat({price}, ' EUR')"
        f" ELSE {price} END AS amount",
    )
