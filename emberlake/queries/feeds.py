"""Feeds: CSV scans, high-water mark, file selection, links, streamed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.functions.times import day_number
from emberlake.operators.measures import max_value
from emberlake.operators.shaping import typed
from emberlake.plans.ingest import ingest
from emberlake.queries import Query, table
from emberlake.session import scratch_folder
from emberlake.sources.files import read_csv, select_new_files
from emberlake.sources.links import extract_links
from emberlake.sources.marks import latest, read_mark, write_mark
from emberlake.sources.tables import file_system, read_table
from emberlake.streaming.daily import append_available, stream_csv

_ORDER_TYPES = {"o_orderkey": "long", "day": "date", "o_totalprice": "double", "o_orderpriority": "string"}


def _order_files(spark: SparkSession, folder: str) -> str:
    """Orders as headed CSV files with one column more than is read."""
    path = scratch_folder(spark, "orders-csv")
    orders = table(spark, folder, "orders").withColumn("latitude", F.to_date("o_orderdate"))
    columns = ["o_orderpriority", "o_custkey", "latitude", "o_orderkey", "o_totalprice"]
    orders.select(*columns).write.option("header", True).csv(path)
    return path


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Columns picked by header name, one renamed, then typed."""
    raw = read_csv(spark, _order_files(spark, folder), list(_ORDER_TYPES), rename={"latitude": "day"})
    return typed(raw, _ORDER_TYPES)


def streamed_files(spark: SparkSession, folder: str) -> DataFrame:
    """The same files taken up by a stream into a raw table."""
    files, raw, checkpoint = _order_files(spark, folder), scratch_folder(spark, "raw"), scratch_folder(spark, "stream")
    header = ["o_orderpriority", "o_custkey", "latitude", "o_orderkey", "o_totalprice"]
    append_available(stream_csv(spark, files, header), raw, checkpoint).awaitTermination()
    return typed(read_table(spark, raw).withColumnRenamed("latitude", "day"), _ORDER_TYPES)


def high_water_mark(spark: SparkSession, folder: str) -> DataFrame:
    """The mark of the events, written as JSON and read back."""
    path = scratch_folder(spark, "mark")
    write_mark(latest(table(spark, folder, "events"), "ts"), path)
    text, day = read_mark(spark, path)
    return latest(table(spark, folder, "events"), "ts").select(
        (F.col("last_date") == text).alias("stored"), "last_date", F.lit(day).alias("last_day")
    )


def _event_files(spark: SparkSession, folder: str) -> tuple[str, dict[int, str]]:
    """Events as one dated CSV file a day, none of them in the ingested folder yet; file by day of the month."""
    path = scratch_folder(spark, "event-days")
    time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts")
    rows = table(spark, folder, "events").select("event_type", time, "event_id", F.date_format("ts", "yyyyMMdd").alias("day"))
    rows.repartition("day").write.option("header", True).partitionBy("day").csv(f"{path}/waiting")
    fs, root = file_system(spark, f"{path}/waiting")
    found = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("day="):
            part = next(s.getPath() for s in fs.listStatus(status.getPath()) if s.getPath().getName().startswith("part-"))
            found[int(name[-2:])] = part.toString()
    fs.mkdirs(file_system(spark, f"{path}/daily")[1])
    return path, found


def ingest_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Two daily ingests: the second takes newer files only, so a late file of an old day is left out."""
    path, files = _event_files(spark, folder)
    fs, _ = file_system(spark, path)
    late = 10

    def arrive(days: list[int]) -> None:
        for day in days:
            fs.rename(file_system(spark, files[day])[1], file_system(spark, f"{path}/daily/focos_br_202401{day:02d}.csv")[1])

    def run() -> None:
        def load(rows: DataFrame) -> None:
            rows.write.mode("append").parquet(f"{path}/raw")

        ingest(spark, f"{path}/daily", f"{path}/mark", load, ["event_id", "ts"], time_column="ts")

    arrive([d for d in files if d <= 15 and d != late])
    run()
    arrive([d for d in files if d > 15 or d == late])
    run()
    mark = read_mark(spark, f"{path}/mark")[0]
    return typed(read_table(spark, f"{path}/raw"), {"event_id": "long", "ts": "timestamp"}).select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), F.lit(mark).alias("last_date")
    )


def max_of_column(spark: SparkSession, folder: str) -> DataFrame:
    return max_value(table(spark, folder, "events"), "ts")


def new_files(spark: SparkSession, folder: str) -> DataFrame:
    """One file name per order day; those after the day of the dearest order are new."""
    orders = table(spark, folder, "orders")
    names = orders.select(
        F.concat(F.lit("data/focos_br_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".csv")).alias("name")
    ).distinct()
    mark = orders.agg(day_number(F.max_by("o_orderdate", "o_totalprice")))
    return select_new_files(names, "name", mark.scalar())


def links(spark: SparkSession, folder: str) -> DataFrame:
    """Every link of every page."""
    return extract_links(table(spark, folder, "pages"), "url", "html", "")


def links_by_suffix(spark: SparkSession, folder: str) -> DataFrame:
    return extract_links(table(spark, folder, "pages"), "url", "html", "e")


def links_in_odd_markup(spark: SparkSession, folder: str) -> DataFrame:
    """The same links in pages that quote, space and hide their markup as real ones do."""
    pages = table(spark, folder, "pages")
    anchor = "<A title='x > y' data-href=\"/no\"\n  HREF = '&#x2F;odd&sol;"
    html = F.replace(F.col("html"), F.lit('<a href="'), F.lit(anchor))
    # Values are single-quoted now: the quote that closes each is the first one after its start.
    pieces = F.split(html, "(?<=&sol;)")
    html = F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(F.regexp_replace(p, '^([^"]*)"', "$1'"))), "")
    before = "<!-- > <a href='/comment'> --><script>'<a href=\"/script\">'</script><textarea><a href=/area></textarea>"
    return extract_links(pages.withColumn("html", F.concat(F.lit(before), html, F.lit("<!-- <a href='/unclosed'>"))), "url", "html", "")


def _links_sql(suffix: str = "", prefix: str = "") -> str:
    """The given pages write every anchor as ``<a href="address">``, without references, and hide none."""
    return (
        f"SELECT page_id, url, concat(url, '{prefix}', split_part(tail, '\"', 1)) AS link FROM ("
        "SELECT page_id, url, unnest(string_split(html, '<a href=\"')[2:]) AS tail FROM pages) "
        f"WHERE contains(tail, '\">') AND ends_with(split_part(tail, '\"', 1), '{suffix}')"
    )


_ORDERS_SQL = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice, o_orderpriority FROM orders"

QUERIES = {
    "csv_scan": Query(csv_scan, _ORDERS_SQL),
    "streamed_files": Query(streamed_files, _ORDERS_SQL),
    "high_water_mark": Query(
        high_water_mark,
        "SELECT true AS stored, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_date, "
        "CAST(strftime(max(ts), '%Y%m%d') AS INTEGER) AS last_day FROM events",
    ),
    "ingest_twice": Query(
        ingest_twice,
        "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, "
        "(SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') FROM events) AS last_date FROM events WHERE day(ts) <> 10",
    ),
    "max_value": Query(max_of_column, "SELECT max(ts) AS ts FROM events"),
    "select_new_files": Query(
        new_files,
        "SELECT DISTINCT concat('data/focos_br_', strftime(o_orderdate, '%Y%m%d'), '.csv') AS name FROM orders "
        "WHERE o_orderdate > (SELECT arg_max(o_orderdate, o_totalprice) FROM orders)",
    ),
    "extract_links": Query(links, _links_sql()),
    "extract_links_suffix": Query(links_by_suffix, _links_sql("e")),
    "extract_links_odd_markup": Query(links_in_odd_markup, _links_sql(prefix="/odd/")),
}
