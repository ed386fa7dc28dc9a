"""Star joins and figures: line items as the fact; orders, customers and nations as dimensions."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.functions.quality import null_outside
from emberlake.operators.lookup import Dimension, star_join, unmatched_counts
from emberlake.operators.measures import count_by, count_charts, headline, options, pairs, with_share
from emberlake.plans.dashboard import ALL, all_of, chosen
from emberlake.queries import Query, table
from emberlake.sources.tables import query


def star(
    spark: SparkSession,
    folder: str,
    status: str,
    first: datetime.date | None = None,
    last: datetime.date | None = None,
    segment: str = ALL,
    nation: str = ALL,
) -> DataFrame:
    """Line items of one status with day, customer and nation; the other filters are optional."""
    day = F.to_date("o_orderdate")
    in_range = None if first is None else day.between(F.lit(first), F.lit(last))
    orders = table(spark, folder, "orders")
    dims = [
        Dimension(
            orders.withColumn("dt_data", day),
            {"l_orderkey": "o_orderkey"},
            {"o_custkey": "o_custkey", "dt_data": "dt_data"},
            in_range,
        ),
        Dimension(
            table(spark, folder, "customer"),
            {"o_custkey": "c_custkey"},
            {"c_nationkey": "c_nationkey", "c_mktsegment": "c_mktsegment"},
            chosen(F.col("c_mktsegment"), segment),
        ),
        Dimension(
            table(spark, folder, "nation"),
            {"c_nationkey": "n_nationkey"},
            {"n_name": "n_name"},
            chosen(F.col("n_name"), nation),
        ),
    ]
    joined = star_join(table(spark, folder, "lineitem"), dims, where=all_of(F.col("l_linestatus") == status))
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_tax",
        "l_discount",
        "o_custkey",
        "c_nationkey",
        "c_mktsegment",
        "n_name",
        "dt_data",
    )


STAR_SQL = """
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_tax, l_discount, o_custkey, c_nationkey,
           c_mktsegment, n_name, CAST(o_orderdate AS DATE) AS dt_data
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    WHERE l_linestatus = '{status}'
"""


def star_inner(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, folder, "F", datetime.date(1996, 1, 1), datetime.date(1998, 12, 31), segment="BUILDING")


def star_named_area(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, folder, "O", nation="NATION_7")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Means differ in their last digits with the order of summation."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def overview_kpis(spark: SparkSession, folder: str) -> DataFrame:
    rows = star(spark, folder, "O", datetime.date(1995, 6, 1), datetime.date(2000, 12, 31))
    rows = rows.withColumn("dry", null_outside(F.col("l_quantity"), high=40)).withColumn("rain", F.col("l_tax"))
    figures = headline(
        rows,
        {"customers": "o_custkey", "nations": "c_nationkey"},
        {"mean_dry": "dry", "mean_rain": "rain"},
    )
    return rounded(figures, "mean_dry", "mean_rain")


def counts_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return count_by(star(spark, folder, "F"), "n_name", "l_orderkey", "n")


def counts_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return count_by(star(spark, folder, "F"), "dt_data", "l_orderkey", "n")


def counts_by_nullable_group(spark: SparkSession, folder: str) -> DataFrame:
    """Null keys are left out and null ids are not counted."""
    orders = table(spark, folder, "orders")
    rows = orders.select(
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_orderkey")).alias("o_orderkey"),
    )
    return count_by(rows, "status", "o_orderkey", "n")


def share_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return with_share(count_by(star(spark, folder, "F"), "c_mktsegment", "l_orderkey", "n"), "n")


def _chart_keys() -> dict[str, Column]:
    return {"area": F.col("n_name"), "day": F.col("dt_data"), "state": F.col("c_mktsegment")}


def chart_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_charts(star(spark, folder, "F"), _chart_keys(), "l_orderkey")


def scatter_pairs(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        null_outside(F.col("l_tax"), high=0.05).alias("rain"),
        null_outside(F.col("l_discount"), low=0.02).alias("risk"),
    )
    return pairs(rows, "rain", "risk")


def filter_options_areas(spark: SparkSession, folder: str) -> DataFrame:
    return options(table(spark, folder, "nation"), ["n_nationkey", "n_name"], "n_name")


def filter_options_states(spark: SparkSession, folder: str) -> DataFrame:
    return options(table(spark, folder, "customer"), ["c_mktsegment"], "c_mktsegment")


def filter_options_satellites(spark: SparkSession, folder: str) -> DataFrame:
    return options(table(spark, folder, "lineitem"), ["l_linestatus"], "l_linestatus")


def fact(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with left-joined ids; customers of one segment only, and periods by a two-column key."""
    orders = table(spark, folder, "orders")
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    periods = orders.select(year.alias("p_year"), month.alias("p_month")).distinct()
    periods = periods.withColumn("period_id", F.col("p_year") * 100 + F.col("p_month"))
    lines = table(spark, folder, "lineitem").withColumns(
        {"ship_year": F.year("l_shipdate"), "ship_month": F.month("l_shipdate")}
    )
    customers = table(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'")
    dims = [
        Dimension(orders, {"l_orderkey": "o_orderkey"}, {"order_id": "o_orderkey", "o_custkey": "o_custkey"}),
        Dimension(
            customers, {"o_custkey": "c_custkey"}, {"customer_id": "c_custkey", "customer_nation": "c_nationkey"}
        ),
        Dimension(table(spark, folder, "nation"), {"customer_nation": "n_nationkey"}, {"nation_id": "n_nationkey"}),
        Dimension(periods, {"ship_year": "p_year", "ship_month": "p_month"}, {"period_id": "period_id"}),
    ]
    valid = F.col("l_discount").between(0.01, 0.09)
    joined = star_join(lines, dims, "left", where=valid.eqNullSafe(True))
    return joined.select(
        "l_orderkey", "l_linenumber", "order_id", "customer_id", "nation_id", "period_id", "l_quantity", "l_tax"
    )


FACT_SQL = """
    SELECT l_orderkey, l_linenumber, o_orderkey AS order_id, c_custkey AS customer_id, n_nationkey AS nation_id,
           period_id, l_quantity, l_tax
    FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (
        SELECT DISTINCT year(o_orderdate) AS p_year, month(o_orderdate) AS p_month,
               CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period_id
        FROM orders
    ) ON year(l_shipdate) = p_year AND month(l_shipdate) = p_month
    WHERE (l_discount BETWEEN 0.01 AND 0.09) IS TRUE
"""


def unmatched_report(spark: SparkSession, folder: str) -> DataFrame:
    return unmatched_counts(fact(spark, folder), ["order_id", "customer_id", "nation_id", "period_id"])


def sql_over_views(spark: SparkSession, folder: str) -> DataFrame:
    return query(
        spark,
        {"serving_orders": table(spark, folder, "orders"), "serving_customer": table(spark, folder, "customer")},
        "SELECT c_mktsegment, count(*) AS n, max(o_totalprice) AS top FROM {serving_orders} "
        "JOIN {serving_customer} ON o_custkey = c_custkey WHERE o_orderstatus = :status GROUP BY c_mktsegment",
        status="F",
    )


def _counts_sql(key: str, name: str) -> str:
    return f"SELECT {key} AS {name}, count(l_orderkey) AS n FROM ({STAR_SQL.format(status='F')}) GROUP BY {key}"


def _chart_sql(chart: str, key: str) -> str:
    return (
        f"SELECT '{chart}' AS chart, CAST({key} AS VARCHAR) AS key, n, n / sum(n) OVER () AS share "
        f"FROM ({_counts_sql(key, key)})"
    )


QUERIES = {
    "star_inner": Query(
        star_inner,
        STAR_SQL.format(status="F")
        + " AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' AND c_mktsegment = 'BUILDING'",
    ),
    "star_named_area": Query(star_named_area, STAR_SQL.format(status="O") + " AND n_name = 'NATION_7'"),
    "overview_kpis": Query(
        overview_kpis,
        "SELECT count(*) AS total, count(DISTINCT o_custkey) AS customers, count(DISTINCT c_nationkey) AS nations, "
        "round(avg(CASE WHEN l_quantity <= 40 THEN l_quantity END), 6) AS mean_dry, round(avg(l_tax), 6) AS mean_rain "
        f"FROM ({STAR_SQL.format(status='O')}) WHERE dt_data BETWEEN DATE '1995-06-01' AND DATE '2000-12-31'",
    ),
    "counts_by_group": Query(counts_by_group, _counts_sql("n_name", "n_name")),
    "counts_by_day": Query(counts_by_day, _counts_sql("dt_data", "dt_data")),
    "counts_by_nullable_group": Query(
        counts_by_nullable_group,
        "SELECT o_orderstatus AS status, count(CASE WHEN o_totalprice > 100000 THEN o_orderkey END) AS n "
        "FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderstatus",
    ),
    "share_by_group": Query(
        share_by_group,
        f"SELECT c_mktsegment, n, n / sum(n) OVER () AS share FROM ({_counts_sql('c_mktsegment', 'c_mktsegment')})",
    ),
    "chart_counts": Query(
        chart_counts,
        " UNION ALL ".join([_chart_sql("area", "n_name"), _chart_sql("day", "dt_data"), _chart_sql("state", "c_mktsegment")]),
    ),
    "scatter_pairs": Query(
        scatter_pairs,
        "SELECT l_tax AS rain, l_discount AS risk FROM lineitem WHERE l_tax <= 0.05 AND l_discount >= 0.02",
    ),
    "filter_options_areas": Query(filter_options_areas, "SELECT DISTINCT n_nationkey, n_name FROM nation ORDER BY n_name"),
    "filter_options_states": Query(
        filter_options_states, "SELECT DISTINCT c_mktsegment FROM customer ORDER BY c_mktsegment"
    ),
    "filter_options_satellites": Query(
        filter_options_satellites, "SELECT DISTINCT l_linestatus FROM lineitem ORDER BY l_linestatus"
    ),
    "build_fact": Query(fact, FACT_SQL),
    "unmatched_report": Query(
        unmatched_report,
        f"WITH fact AS ({FACT_SQL}) "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS dimension, count(*) - count({c}) AS unmatched FROM fact"
            for c in ("order_id", "customer_id", "nation_id", "period_id")
        ),
    ),
    "sql_over_views": Query(
        sql_over_views,
        "SELECT c_mktsegment, count(*) AS n, max(o_totalprice) AS top FROM orders "
        "JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY c_mktsegment",
    ),
}
