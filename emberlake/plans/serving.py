"""Publishing tables to a serving database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.functions.geometry import SRID, set_srid
from emberlake.schemas import SERVING_SCHEMA, ServingTable


def create_statements(table: ServingTable, schema: str = SERVING_SCHEMA) -> list[str]:
    """Statements that create the schema and the table unless they exist."""
    columns = ", ".join(f"{name} {kind}" for name, kind in table.columns.items())
    return [f"CREATE SCHEMA IF NOT EXISTS {schema}", f"CREATE TABLE IF NOT EXISTS {schema}.{table.name} ({columns})"]


def ensure_table(
    spark: SparkSession, table: ServingTable, connection: Mapping[str, str], schema: str = SERVING_SCHEMA
) -> None:
    """Create the table if absent, by statements that Spark runs when it opens a session for a one-row read."""
    for statement in create_statements(table, schema):
        reader = spark.read.format("jdbc").options(**connection).option("sessionInitStatement", statement)
        reader.option("query", "SELECT 1 AS one").load().collect()


def publishable(df: DataFrame, table: ServingTable, srid: int = SRID) -> DataFrame:
    """The table's columns in order, geometry as EWKB with ``srid``."""
    return df.select(*[set_srid(F.col(c), srid).alias(c) if c == table.geometry else F.col(c) for c in table.columns])


def write_options(table: ServingTable, connection: Mapping[str, str], schema: str = SERVING_SCHEMA) -> dict[str, str]:
    """JDBC options of a publish: rows are replaced, the table definition stays.

    ``connection`` may hold any other option of the writer. ``numPartitions`` there limits the connections; the frame
    is then also computed in as many tasks. Without it every partition of the frame opens one.
    """
    return {
        "batchsize": "10000",
        **connection,
        "dbtable": f"{schema}.{table.name}",
        "truncate": "true",
    }


def publish(
    df: DataFrame, table: ServingTable, connection: Mapping[str, str], schema: str = SERVING_SCHEMA, srid: int = SRID
) -> None:
    """Replace the rows of a serving table with ``df``; ``connection`` holds url, user, password, driver."""
    ensure_table(df.sparkSession, table, connection, schema)
    options = write_options(table, connection, schema)
    publishable(df, table, srid).write.format("jdbc").options(**options).mode("overwrite").save()
