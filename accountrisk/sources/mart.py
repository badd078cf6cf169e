"""Account table built from customer, order and line-item facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SNAPSHOT = "2000-08-01"
#: The year before: the reference batch of drift audits.
EARLIER_SNAPSHOT = "1999-08-01"

# Categories this mart can hold; passed to the contract in place of the default sets.
MART_CATEGORIES = {
    "industry": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "payment_method": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
}
#: The contract of a seller to four segments in four regions, which refuses the mart's other accounts.
SERVED_CATEGORIES = {
    "industry": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"],
    "payment_method": ["AFRICA", "AMERICA", "ASIA", "EUROPE"],
}

# Declared schemas: no job is spent on reading file footers, and a drifting file fails early.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def expressions(**columns: str) -> list:
    """Named SQL expressions as columns."""
    return [F.expr(f"{text} AS {name}") for name, text in columns.items()]


def brand_numbers(part: DataFrame) -> DataFrame:
    """Brands numbered from 0; as many rows as there are brands."""
    brands = part.select("p_brand").where("p_brand IS NOT NULL").distinct()
    return brands.select("p_brand", (F.row_number().over(Window.orderBy("p_brand")) - 1).alias("brand_no"))


def line_facts(lines: DataFrame, part: DataFrame, words: int) -> DataFrame:
    """Line aggregates per order, before lines meet their orders.

    The set of an order's brands is a bit per brand in ``words`` 64-bit numbers, so sets of orders merge by OR and no
    row is kept per (order, brand).
    """
    numbered = part.select("p_partkey", "p_brand").join(brand_numbers(part), "p_brand", "left").drop("p_brand")
    brands = {
        f"brands_{w}": f"bit_or(CASE WHEN brand_no DIV 64 = {w} THEN shiftleft(1L, CAST(brand_no % 64 AS INT)) END)"
        for w in range(words)
    }
    return (
        lines.join(numbered, F.expr("l_partkey = p_partkey"), "left")
        .groupBy("l_orderkey")
        .agg(
            *expressions(
                n_lines="count(*)",
                quantity="sum(l_quantity)",
                revenue="sum(l_extendedprice * (1D - l_discount))",
                tax="sum(l_tax)",
                n_returned="count_if(l_returnflag = 'R')",
                n_returned_open="count_if(l_returnflag = 'R' AND l_linestatus = 'O')",
                **brands,
            )
        )
    )


def account_facts(orders: DataFrame, per_order: DataFrame, snapshots: Sequence[str], words: int) -> DataFrame:
    """History, recency, lines and the label's count per customer and snapshot, in one conditional aggregate over one
    scan of the orders.

    Floating sums are rounded to their exact scale before any division, which makes them independent
    of the order of addition.
    """
    days = [F.expr(f"TIMESTAMP_NTZ '{s}'") for s in snapshots]
    day = days[0] if len(days) == 1 else F.explode(F.array(*days))
    history = "(WHERE o_orderdate < day)"
    recent = "(WHERE o_orderdate < day AND o_orderdate >= day - INTERVAL 12 MONTHS)"
    wanted = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"]
    return (
        orders.select(*wanted)
        .join(per_order, F.expr("l_orderkey = o_orderkey"), "left")
        .select("*", day.alias("day"))
        .groupBy("o_custkey", "day")
        .agg(
            *expressions(
                n_orders="count_if(o_orderdate < day)",
                n_urgent="count_if(o_orderdate < day AND o_orderpriority IN ('1-URGENT', '2-HIGH'))",
                first_order=f"min(o_orderdate) FILTER {history}",
                n_recent="count_if(o_orderdate < day AND o_orderdate >= day - INTERVAL 6 MONTHS)",
                n_future="count_if(o_orderdate >= day)",
                n_lines=f"sum(n_lines) FILTER {history}",
                n_lines_recent=f"sum(n_lines) FILTER {recent}",
                quantity=f"round(sum(quantity) FILTER {history}, 4)",
                quantity_recent=f"round(sum(quantity) FILTER {recent}, 4)",
                revenue=f"round(sum(revenue) FILTER {history}, 4)",
                tax=f"round(sum(tax) FILTER {history}, 4)",
                n_returned=f"sum(n_returned) FILTER {history}",
                n_returned_open=f"sum(n_returned_open) FILTER {history}",
                n_returned_recent=f"sum(n_returned) FILTER {recent}",
                n_brands=" + ".join(f"bit_count(coalesce(bit_or(brands_{w}) FILTER {history}, 0L))" for w in range(words)),
            )
        )
        .where("n_orders > 0")
    )


def account_mart(spark: SparkSession, folder: str, snapshot: str = SNAPSHOT) -> DataFrame:
    """One row per customer with order history before ``snapshot``."""
    return account_snapshots(spark, folder, [snapshot]).drop("snapshot")


def account_snapshots(spark: SparkSession, folder: str, snapshots: Sequence[str]) -> DataFrame:
    """One row per customer and snapshot with order history before it; ``snapshot`` is the date as text.

    Every table is scanned once, whatever the number of snapshots. Lines shrink to their orders before they meet
    them; joins are equi-joins whose strategy Spark picks by size.
    """
    part = table(spark, folder, "part")
    words = max(1, -(-part.select("p_brand").distinct().count() // 64))
    facts = account_facts(
        table(spark, folder, "orders"), line_facts(table(spark, folder, "lineitem"), part, words), snapshots, words
    )
    geography = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.expr("n_regionkey = r_regionkey")
    )
    customer = table(spark, folder, "customer").join(
        geography.select("n_nationkey", "r_name"), F.expr("c_nationkey = n_nationkey"), "left"
    )
    joined = facts.join(customer, F.expr("o_custkey = c_custkey")).withColumn(
        "months",
        F.expr(
            "greatest((year(day) - year(first_order)) * 12 + month(day) - month(first_order), 1)"
        ),
    )
    return joined.select(
        *expressions(
            snapshot="date_format(day, 'yyyy-MM-dd')",
            customer_id="c_custkey",
            industry="c_mktsegment",
            company_size_bracket="CASE WHEN n_orders <= 5 THEN '1-10' WHEN n_orders <= 7 THEN '11-50'"
            " WHEN n_orders <= 9 THEN '51-200' WHEN n_orders <= 12 THEN '201-1000'"
            " ELSE '1000+' END",
            plan_tier="CASE WHEN c_acctbal < 3000D THEN 'Starter' WHEN c_acctbal < 7000D"
            " THEN 'Professional' ELSE 'Enterprise' END",
            billing_cycle="CASE WHEN n_urgent * 2 >= n_orders THEN 'Monthly'"
            " WHEN n_urgent * 4 >= n_orders THEN 'Annual' ELSE 'Multi-Year' END",
            payment_method="r_name",
            auto_renew_enabled="n_recent > 0",
            contract_duration_months="months",
            contracted_seats="CAST(coalesce(quantity, 0D) AS BIGINT)",
            active_users_last_30d="CAST(coalesce(quantity_recent, 0D) AS BIGINT)",
            monthly_recurring_revenue="coalesce(revenue, 0D) / months",
            avg_daily_logins="coalesce(n_lines_recent, 0L) / 12D",
            feature_adoption_score="100D * coalesce(n_brands, 0L) / 25D",
            storage_usage_pct="1000D * tax / n_lines",
            support_tickets_count="coalesce(n_returned, 0L)",
            unresolved_tickets_count="coalesce(n_returned_open, 0L)",
            nps_score="CASE WHEN n_lines_recent > 0"
            " THEN 10D * (1D - n_returned_recent / n_lines_recent) END",
            invoice_delay_days="CASE WHEN c_acctbal < 0D THEN -c_acctbal / 20D ELSE 0D END",
            churn="CAST(n_future = 0 AS INT)",
        )
    )
