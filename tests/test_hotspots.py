"""The chain from files to figures on a small hand-written feed."""

import datetime
import hashlib

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F
from shapes import polygon, write_layer
from test_layers import BIOME_FIELDS, FAR, SQUARE, TOWN_FIELDS

from emberlake.functions.keys import surrogate_key
from emberlake.operators.lookup import DuplicateKeyError, unmatched_counts
from emberlake.plans.dashboard import Filters, chart_counts, charts, filter_options, hotspot_star, map_points, overview, with_wkt
from emberlake.plans.dimensions import build_dimension, clean_layer, extend_date_dimension
from emberlake.plans.fact import FACT_IDS, build_fact, refresh_fact
from emberlake.plans.hotspots import clean_hotspots, keyed_distinct, load_hotspots, read_feeds, typed_readings
from emberlake.plans.serving import create_statements, publishable, write_options
from emberlake.schemas import BIOME_DIMENSION, BIOME_LAYER, MUNICIPALITY_DIMENSION, MUNICIPALITY_LAYER, RAW_HOTSPOT, SERVING
from emberlake.sinks.tables import overwrite_table
from emberlake.sources.layers import read_layer
from emberlake.sources.tables import read_table

HEADER = ",".join(RAW_HOTSPOT)
DAILY = [
    "-3.5,-52.25,2024-01-31 23:59:59,aqua_m-t,São Félix do Xingu,Pará,Amazônia,3.0,0.0,0.15,1.0E7",
    "-3.5,-52.25,2024-01-31 23:59:59,aqua_m-t,São Félix do Xingu,Pará,Amazônia,3.0,0.0,0.15,1.0E7",
    "90.01,-52.25,2024-02-01 00:00:00,AQUA_M-T,Agudo,Rio Grande do Sul,Pampa,-999,-999,-999,",
    "-29.5,-53.25,2024-02-01 10:00:00,AQUA_M-T,Agudo,Rio Grande do Sul,Pampa,12,0.5,0.96,2.5",
    "-29.5,-53.25,2024-02-01 10:00:00,TERRA,Agudo,Rio Grande do Sul,Pampa,12,0.5,0.96,2.5",
    "-10,-50,2024-02-02 10:00:00,AQUA_M-T,Belém,Pará,Oceano,x,0.5,1.01,2.5",
    "-10,-50,2024-02-02 10:00:00,AQUA_M-T,,Atlântida,,,,,",
]
MONTHLY = [DAILY[0], "-15.6,-56.1,2023-12-31 12:00:00,AQUA_M-T,Belém,Pará,Amazônia,0,1.5,0.4,3.5"]
YEARLY_HEADER = "id_bdq,foco_id,latitude,longitude,data_pas,satelite,pais,estado,municipio,bioma,numero_dias_sem_chuva,precipitacao,risco_fogo,frp"
YEARLY = ["1,f,-15.6,-56.1,2022-06-01 12:00:00,AQUA_M-T,Brasil,Pará,Belém,Amazônia,7,0,0.7,3.5"]


def write(folder, name, header, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *rows]) + "\n", encoding="utf-8")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    write(root / "daily", "focos_br_20240202.csv", HEADER, DAILY)
    write(root / "monthly", "focos_br_202312.csv", HEADER, MONTHLY)
    write(root / "yearly", "focos_br_2022.csv", YEARLY_HEADER, YEARLY)
    towns = [("1507300", "São Félix do Xingu", "PA"), ("1501402", "Belém", "PA"), ("4300109", "Agudo", "RS"), ("2100000", "Belém", "MA")]
    write_layer(root / "towns", "t", TOWN_FIELDS, [(polygon(SQUARE), [c, n, s, "1.5"]) for c, n, s in towns])
    biomes = [("1", "AM", "Amazônia"), ("2", "PP", "Pampa")]
    write_layer(root / "biomes", "b", BIOME_FIELDS, [(polygon(FAR), list(b)) for b in biomes])
    path = {n: str(root / n) for n in ("daily", "monthly", "yearly", "trusted", "dm_data", "dm_municipio", "dm_bioma", "ft")}
    for folder, layer, names, target in (
        ("towns", MUNICIPALITY_LAYER, MUNICIPALITY_DIMENSION, "dm_municipio"),
        ("biomes", BIOME_LAYER, BIOME_DIMENSION, "dm_bioma"),
    ):
        cleaned = clean_layer(read_layer(spark, str(root / folder)), layer)
        overwrite_table(build_dimension(cleaned, names), path[target])
    load_hotspots(clean_hotspots(read_feeds(spark, path["daily"], path["monthly"], path["yearly"])), path["trusted"])
    refresh_fact(
        spark, path["trusted"], path["dm_data"], path["dm_municipio"], path["dm_bioma"], path["ft"], datetime.date(2022, 1, 1)
    )
    return path


def tables(spark, lake):
    return [read_table(spark, lake[n]) for n in ("ft", "dm_data", "dm_municipio", "dm_bioma")]


def test_trusted_rows(spark, lake):
    trusted = read_table(spark, lake["trusted"])
    assert trusted.count() == 8
    row = trusted.filter("municipio = 'SAO FELIX DO XINGU'").first()
    text = "-3.5_-52.25_2024-01-31 23:59:59_aqua_m-t_São Félix do Xingu_Pará_Amazônia_3.0_0.0_0.15_1.0E7"
    assert row.id == hashlib.md5(text.encode()).hexdigest().upper()
    assert (row.satelite, row.estado, row.sigla_estado, row.bioma) == ("AQUA_M-T", "PARA", "PA", "AMAZONIA")
    assert (row.fire_risk_category, row.numero_dias_sem_chuva, row.year, row.month) == ("MINIMO", 3, 2024, 1)
    assert (row.valid_lat, row.valid_coordinates, row.dt_data) == (True, True, datetime.date(2024, 1, 31))
    bad = trusted.filter("NOT valid_lat").first()
    assert (bad.numero_dias_sem_chuva, bad.precipitacao, bad.risco_fogo, bad.frp) == (None, None, None, None)
    assert (bad.fire_risk_category, bad.valid_lon, bad.valid_coordinates) == ("INVALIDO", True, False)
    # A cell that is no number and a risk above the range become null.
    odd = trusted.filter("bioma = 'OCEANO'").first()
    assert (odd.numero_dias_sem_chuva, odd.risco_fogo, odd.sigla_estado) == (None, None, "PA")
    assert trusted.filter("estado = 'ATLANTIDA'").first().sigla_estado is None


def test_clean_has_one_shuffle_and_no_python(spark, lake):
    plan = plan_of(clean_hotspots(read_feeds(spark, lake["daily"], lake["monthly"], lake["yearly"])))
    assert plan.count("Exchange") == 1 and "Python" not in plan


@pytest.mark.parametrize("null_token", [None, "?"])
def test_reload_and_slices_give_the_same_table(spark, lake, tmp_path, null_token):
    raw = read_feeds(spark, lake["daily"], lake["monthly"], lake["yearly"])
    whole, sliced = str(tmp_path / "whole"), str(tmp_path / "sliced")
    load_hotspots(clean_hotspots(raw, null_token), whole)
    slices = [raw.filter("satelite <> 'TERRA'"), raw.filter("satelite = 'TERRA' OR bioma = 'Pampa'"), raw]
    for part in slices:
        load_hotspots(clean_hotspots(part, null_token), sliced, whole_rows_keyed=null_token is not None)
    assert rows_of(read_table(spark, sliced)) == rows_of(read_table(spark, whole))


def test_neighbouring_nulls_share_a_key_unless_a_token_is_set(spark):
    cells = ["1", "2", "2024-01-01 00:00:00", "s", "m", "e", "b", "1", None, "0.5", "2"]
    other = cells[:8] + ["0.5", None, "2"]
    raw = spark.createDataFrame([tuple(cells), tuple(other)], ", ".join(f"{c} string" for c in RAW_HOTSPOT))
    assert clean_hotspots(raw).select("id").distinct().count() == 1
    assert clean_hotspots(raw).count() == 2
    assert clean_hotspots(raw, "?").select("id").distinct().count() == 2


def test_signed_zeros_and_fractional_days_keep_their_own_keys(spark):
    """As a dedup of keyed rows does: equal values, different key text."""
    cells = ["0.0", "2", "2024-01-01 00:00:00", "s", "m", "e", "b", "3.2", "0.0", "0.5", "NaN"]
    variants = [cells, cells, ["-0.0", *cells[1:]], [*cells[:8], "-0.0", *cells[9:]], [*cells[:7], "3.7", *cells[8:]], ["0", *cells[1:]]]
    raw = spark.createDataFrame([tuple(v) for v in variants], ", ".join(f"{c} string" for c in RAW_HOTSPOT))
    readings = typed_readings(raw)
    plain = readings.select(surrogate_key([F.col(c) for c in RAW_HOTSPOT]).alias("id"), "*").dropDuplicates()
    assert rows_of(keyed_distinct(readings).select("id")) == rows_of(plain.select("id"))
    got = clean_hotspots(raw)
    assert got.count() == got.select("id").distinct().count() == 4


def test_date_dimension_reaches_the_last_hotspot_and_is_extended(spark, lake, tmp_path):
    days = read_table(spark, lake["dm_data"])
    assert tuple(days.agg(F.min("dt_data"), F.max("dt_data"), F.count("*")).first()) == (
        datetime.date(2022, 1, 1),
        datetime.date(2024, 2, 2),
        763,
    )
    path = str(tmp_path / "days")
    first = datetime.date(2024, 1, 1)
    for day in (5, 3, 5, 7):
        extend_date_dimension(spark, path, datetime.date(2024, 1, day), first)
    got = read_table(spark, path).orderBy("dt_data").collect()
    assert [r.qtd_dia for r in got] == list(range(1, 8))
    assert tuple(got[0]) == (-456589419, 1, 1, 2024, first)


def test_fact(spark, lake):
    fact = read_table(spark, lake["ft"])
    assert fact.columns[:10] == list(SERVING["ft_queimada"].columns)
    assert fact.count() == 7
    got = {r.id_municipio: r for r in fact.filter("des_satelite = 'AQUA_M-T' AND year = 2024").collect()}
    assert (got[1507300].id_bioma, got[4300109].id_bioma, got[1501402].id_bioma) == (1, 2, None)
    assert got[None].id_bioma is None and got[None].id_data is not None
    assert rows_of(unmatched_counts(fact, FACT_IDS)) == [("id_bioma", 2), ("id_data", 0), ("id_municipio", 1)]


def test_fact_without_date_dimension_keeps_rows(spark, lake):
    _, days, towns, biomes = tables(spark, lake)
    fact = build_fact(read_table(spark, lake["trusted"]), days.filter("dt_data < DATE'2024-02-01'"), towns, biomes)
    assert fact.count() == 7 and fact.filter("id_data IS NULL").count() == 4


def test_repeated_dimension_name(spark, lake):
    _, days, towns, biomes = tables(spark, lake)
    twice = biomes.unionByName(biomes.withColumn("id_bioma", F.col("id_bioma") + 10))
    trusted = read_table(spark, lake["trusted"])
    with pytest.raises(DuplicateKeyError):
        build_fact(trusted, days, towns, twice)
    assert build_fact(trusted, days, towns, twice, unique=False).count() == 12


def star(spark, lake, **choices):
    filters = Filters("AQUA_M-T", datetime.date(2022, 1, 1), datetime.date(2024, 12, 31))
    return hotspot_star(*tables(spark, lake), Filters(**{**filters.__dict__, **choices}))


def test_star_filters(spark, lake):
    assert star(spark, lake).count() == 4
    assert star(spark, lake, satellite="TERRA").count() == 1
    assert star(spark, lake, biome="PAMPA").count() == 1
    assert star(spark, lake, state="PA").count() == 3
    assert star(spark, lake, municipality="BELEM").count() == 2
    assert star(spark, lake, municipality="BELEM", state="MA").count() == 0
    assert star(spark, lake, first_day=datetime.date(2023, 12, 31), last_day=datetime.date(2024, 1, 31)).count() == 2


def test_star_prunes_partitions_and_columns(spark, lake):
    month = star(spark, lake, first_day=datetime.date(2024, 1, 5), last_day=datetime.date(2024, 1, 31))
    plan = plan_of(overview(month))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "qtd_dias_sem_chuva" in line)
    assert "PartitionFilters: [((year#" in scan and "EqualTo(des_satelite,AQUA_M-T)" in scan
    assert "geom" not in scan and "vl_frp" not in scan
    assert plan.count("BroadcastHashJoin") == 3 and "Python" not in plan


def test_overview_charts_and_points(spark, lake):
    rows = star(spark, lake)
    assert tuple(overview(rows).first()) == (4, 3, 2, pytest.approx(5.5), pytest.approx(0.5))
    got = charts(rows)
    assert [tuple(r) for r in got["bioma"].collect()] == [("AMAZONIA", 3), ("PAMPA", 1)]
    assert [r.total for r in got["data"].collect()] == [1, 1, 1, 1]
    assert [tuple(r) for r in got["estado"].collect()] == [("PA", 3, 0.75), ("RS", 1, 0.25)]
    assert got["dispersao"].count() == 4
    assert {(r.chart, r.key): r.n for r in chart_counts(rows).collect()}[("estado", "PA")] == 3
    point = map_points(rows).filter("municipio_nome = 'AGUDO'").first()
    assert (point.latitude, point.longitude) == (-29.5, -53.25)
    assert "POINT(-53.25 -29.5)" in {r.geom_foco for r in with_wkt(rows).collect()}


def test_filter_options(spark, lake):
    fact, _, towns, biomes = tables(spark, lake)
    lists = {n: [tuple(r) for r in df.collect()] for n, df in filter_options(fact, towns, biomes).items()}
    assert lists["biomas"] == [(1, "AMAZONIA"), (2, "PAMPA")]
    assert lists["estados"] == [("MA",), ("PA",), ("RS",)]
    assert [n for _, n in lists["municipios"]] == ["AGUDO", "BELEM", "BELEM", "SAO FELIX DO XINGU"]
    assert lists["satelites"] == [("AQUA_M-T",), ("TERRA",)]


def test_publish_frame_and_options(spark, lake):
    fact = read_table(spark, lake["ft"])
    ready = publishable(fact, SERVING["ft_queimada"])
    assert ready.columns == list(SERVING["ft_queimada"].columns)
    assert {bytes(r[0])[5:9] for r in ready.select("geom_foco").collect()} == {(4674).to_bytes(4, "little")}
    options = write_options(SERVING["dm_data"], {"url": "jdbc:x", "user": "u", "batchsize": "5"})
    assert options["dbtable"] == "wildfires.dm_data" and options["truncate"] == "true" and options["batchsize"] == "5"
    assert create_statements(SERVING["dm_bioma"]) == [
        "CREATE SCHEMA IF NOT EXISTS wildfires",
        "CREATE TABLE IF NOT EXISTS wildfires.dm_bioma "
        "(id_bioma INTEGER, vl_codigo VARCHAR, des_nome VARCHAR, geom_bioma GEOMETRY)",
    ]
