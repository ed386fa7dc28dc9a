"""Names and types of the fire-hotspot tables; everything else in the library takes names as parameters."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

# Columns of the raw feeds and the types they are read as.
RAW_HOTSPOT = {
    "lat": "double",
    "lon": "double",
    "data_hora_gmt": "timestamp",
    "satelite": "string",
    "municipio": "string",
    "estado": "string",
    "bioma": "string",
    "numero_dias_sem_chuva": "double",
    "precipitacao": "double",
    "risco_fogo": "double",
    "frp": "double",
}

# Names the yearly files use for the same columns.
YEARLY_NAMES = {"latitude": "lat", "longitude": "lon", "data_pas": "data_hora_gmt"}

# Allowed range of readings, None for no limit.
READING_RANGES = {"numero_dias_sem_chuva": (0, None), "precipitacao": (0, None), "risco_fogo": (0, 1)}

HOTSPOT_KEY = ["id"]
HOTSPOT_PARTITIONS = ["year", "month"]

# Trusted name -> (layer attribute, type).
MUNICIPALITY_LAYER = {
    "codigo_municipio": ("CD_MUN", "int"),
    "nome_municipio": ("NM_MUN", "string"),
    "sigla_uf": ("SIGLA_UF", "string"),
    "area_km2": ("AREA_KM2", "double"),
    "geom": ("geometry", "binary"),
}
BIOME_LAYER = {
    "id": ("ID1", "int"),
    "code_bioma": ("COD_BIOMA", "string"),
    "nome_bioma": ("NOM_BIOMA", "string"),
    "geom": ("geometry", "binary"),
}

# Dimension column -> trusted column.
MUNICIPALITY_DIMENSION = {
    "id_municipio": "codigo_municipio",
    "des_nome": "nome_municipio",
    "des_sigla": "sigla_uf",
    "vl_area": "area_km2",
    "geom_municipio": "geom",
}
BIOME_DIMENSION = {
    "id_bioma": "id",
    "vl_codigo": "code_bioma",
    "des_nome": "nome_bioma",
    "geom_bioma": "geom",
}

# Fact column -> trusted column, for the columns no join supplies.
FACT_MEASURES = {
    "id_queimada": "id",
    "des_satelite": "satelite",
    "qtd_dias_sem_chuva": "numero_dias_sem_chuva",
    "vl_precipitacao": "precipitacao",
    "vl_risco_fogo": "risco_fogo",
    "vl_frp": "frp",
}


@dataclass(frozen=True)
class ServingTable:
    """A published table: its column types in the serving database and its geometry column, if any."""

    name: str
    columns: Mapping[str, str]
    geometry: str | None = None


SERVING_SCHEMA = "wildfires"

# The serving tables.
SERVING = {
    "ft_queimada": ServingTable(
        "ft_queimada",
        {
            "id_queimada": "VARCHAR",
            "id_data": "INTEGER",
            "id_municipio": "INTEGER",
            "id_bioma": "INTEGER",
            "des_satelite": "VARCHAR",
            "qtd_dias_sem_chuva": "INTEGER",
            "vl_precipitacao": "FLOAT8",
            "vl_risco_fogo": "FLOAT8",
            "vl_frp": "FLOAT8",
            "geom_foco": "GEOMETRY",
        },
        "geom_foco",
    ),
    "dm_data": ServingTable(
        "dm_data",
        {"id_data": "INTEGER", "qtd_dia": "INTEGER", "qtd_mes": "INTEGER", "qtd_ano": "INTEGER", "dt_data": "DATE"},
    ),
    "dm_municipio": ServingTable(
        "dm_municipio",
        {
            "id_municipio": "INTEGER",
            "des_nome": "VARCHAR",
            "des_sigla": "VARCHAR",
            "vl_area": "FLOAT8",
            "geom_municipio": "GEOMETRY",
        },
        "geom_municipio",
    ),
    "dm_bioma": ServingTable(
        "dm_bioma",
        {"id_bioma": "INTEGER", "vl_codigo": "VARCHAR", "des_nome": "VARCHAR", "geom_bioma": "GEOMETRY"},
        "geom_bioma",
    ),
}
