"""Every registered query against its SQL in DuckDB."""

import math

import duckdb
import pytest
from conftest import plan_of

import __spark_entry__ as entry_point
from emberlake.queries import registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}
# Only encoding and decoding of geometry and the reading of web pages leave the JVM.
WITH_PYTHON = {"extract_links", "extract_links_suffix", "extract_links_odd_markup", "point_ewkb", "srid_relabel", "map_points", "hotspot_fact", "layer_scan", "layer_clean", "area_dimension", "area_transform"}


@pytest.fixture(scope="module")
def engine(data):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return connection


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(value):
        return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", registry())
def test_query_agrees_with_sql(spark, data, engine, name):
    df = entry_point.queries()[name](spark, data)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Python" not in plan or name in WITH_PYTHON
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    cursor = engine.execute(entry_point.oracle_sql()[name])
    columns = {c[0]: str(c[1]) for c in cursor.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == columns
    expected = canonical(cursor.fetchall(), list(columns))
    assert len(got) > 0
    assert got == expected


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["total", "customers", "nations", "mean_dry", "mean_rain"]
    assert df.count() == 1


@pytest.mark.parametrize("name", ["chart_counts", "overview_kpis"])
def test_figures_scan_the_fact_once(spark, data, name):
    """Totals reuse the grouped rows instead of reading the fact again."""
    df = entry_point.queries()[name](spark, data)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet [l_orderkey") == 1


def test_share_reuses_the_counts(spark, data):
    """The subquery for the total reads the shuffled counts; its final plan has no scan of its own."""
    df = entry_point.queries()["share_by_group"](spark, data)
    df.collect()
    subquery = plan_of(df).split("Subquery subquery")[-1]
    final = subquery.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and "FileScan" not in final
