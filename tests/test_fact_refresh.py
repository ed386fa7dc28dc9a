"""The fact follows its sources month by month."""

import datetime

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from emberlake.plans import fact as plan
from emberlake.plans.dimensions import missing_date_rows
from emberlake.plans.fact import build_fact, refresh_fact
from emberlake.schemas import FACT_MEASURES, HOTSPOT_PARTITIONS
from emberlake.sinks.tables import append_missing, overwrite_table, upsert_table
from emberlake.sources.tables import current_version, read_table

FIRST = datetime.date(2023, 12, 1)


def hotspots(spark, days):
    """One valid hotspot of each (id, day, rain)."""
    rows = spark.createDataFrame([(i, datetime.date.fromisoformat(d), r) for i, d, r in days], "id string, dt_data date, precipitacao double")
    extra = [F.lit("AQUA_M-T").alias(c) if c == "satelite" else F.lit(None).cast("double").alias(c) for c in FACT_MEASURES.values() if c not in rows.columns]
    fixed = {"lat": -3.5, "lon": -52.25, "valid_coordinates": True, "bioma": "PAMPA", "municipio": "AGUDO", "sigla_estado": "RS"}
    rows = rows.select("*", *extra).withColumns({c: F.lit(v) for c, v in fixed.items()})
    return rows.withColumns({"year": F.year("dt_data"), "month": F.month("dt_data")})


@pytest.fixture
def lake(spark, tmp_path):
    path = {n: str(tmp_path / n) for n in ("trusted", "days", "towns", "biomes", "fact")}
    first = [("a", "2024-01-05", 1.0), ("b", "2024-01-06", 2.0), ("c", "2024-02-01", 3.0)]
    overwrite_table(hotspots(spark, first), path["trusted"], HOTSPOT_PARTITIONS)
    overwrite_table(spark.sql("SELECT 7 AS id_municipio, 'AGUDO' AS des_nome, 'RS' AS des_sigla"), path["towns"])
    overwrite_table(spark.sql("SELECT 1 AS id_bioma, 'PAMPA' AS des_nome"), path["biomes"])
    return path


def refreshed(spark, lake):
    """Folders of the fact after a refresh, which must equal a fact built anew."""
    refresh_fact(spark, *lake.values(), FIRST)
    tables = [read_table(spark, lake[n]) for n in ("trusted", "days", "towns", "biomes")]
    found = read_table(spark, lake["fact"])
    assert rows_of(found) == rows_of(build_fact(*tables).select(*found.columns))
    return set(current_version(spark, lake["fact"]).folders)


def months(folders):
    return {f.rpartition("/")[0] for f in folders}


def test_only_changed_months_are_built_anew(spark, lake):
    one = refreshed(spark, lake)
    assert months(one) == {"year=2024/month=1", "year=2024/month=2"}
    # Nothing new: no version is written.
    number = current_version(spark, lake["fact"]).number
    assert refreshed(spark, lake) == one and current_version(spark, lake["fact"]).number == number
    # A new day and a corrected reading in February, and a new month with it.
    news = hotspots(spark, [("c", "2024-02-01", 9.0), ("d", "2024-02-03", 4.0), ("e", "2024-03-01", 5.0)])
    upsert_table(news, lake["trusted"], ["id"], HOTSPOT_PARTITIONS)
    two = refreshed(spark, lake)
    assert months(one & two) == {"year=2024/month=1"}
    assert months(two - one) == {"year=2024/month=2", "year=2024/month=3"}
    # A month that is gone from the trusted table goes from the fact.
    overwrite_table(read_table(spark, lake["trusted"]).where("month <> 1"), lake["trusted"], HOTSPOT_PARTITIONS)
    assert months(refreshed(spark, lake)) == {"year=2024/month=2", "year=2024/month=3"}


def test_changed_dimensions_build_all_anew(spark, lake):
    one = refreshed(spark, lake)
    overwrite_table(spark.sql("SELECT 8 AS id_municipio, 'AGUDO' AS des_nome, 'RS' AS des_sigla"), lake["towns"])
    two = refreshed(spark, lake)
    assert not one & two and {r.id_municipio for r in read_table(spark, lake["fact"]).collect()} == {8}
    # A fact written by other means tells nothing of its sources.
    overwrite_table(read_table(spark, lake["fact"]), lake["fact"], HOTSPOT_PARTITIONS)
    three = set(current_version(spark, lake["fact"]).folders)
    assert not three & refreshed(spark, lake)


def test_days_that_were_missing_reach_older_months(spark, lake, monkeypatch):
    """The first build knows the dates from February on, then those before are put in."""
    refresh_fact(spark, *lake.values(), datetime.date(2024, 2, 1))
    one = set(current_version(spark, lake["fact"]).folders)
    assert read_table(spark, lake["fact"]).where("id_data IS NULL").count() == 2
    until = spark.sql("SELECT DATE'2024-01-31' AS last")
    append_missing(missing_date_rows(None, until, "last", FIRST), lake["days"], ["id_data"])
    built, plain = [], plan.replace_folders
    monkeypatch.setattr(plan, "replace_folders", lambda df, path, version, stale, *rest: built.append(stale) or plain(df, path, version, stale, *rest))
    two = refreshed(spark, lake)
    assert built == [{"year=2024/month=1"}] and months(one & two) == {"year=2024/month=2"}
    assert read_table(spark, lake["fact"]).where("id_data IS NULL").count() == 0
