"""Range rules, bands, validity flags and code lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inclusive upper limit and name of each fire-risk band.
RISK_BANDS = ((0.15, "MINIMO"), (0.4, "BAIXO"), (0.7, "MEDIO"), (0.95, "ALTO"), (1.0, "CRITICO"))
NO_BAND = "INVALIDO"

# Normalised state name and its code.
STATE_CODES = {
    "ACRE": "AC",
    "ALAGOAS": "AL",
    "AMAPA": "AP",
    "AMAZONAS": "AM",
    "BAHIA": "BA",
    "CEARA": "CE",
    "DISTRITO FEDERAL": "DF",
    "ESPIRITO SANTO": "ES",
    "GOIAS": "GO",
    "MARANHAO": "MA",
    "MATO GROSSO": "MT",
    "MATO GROSSO DO SUL": "MS",
    "MINAS GERAIS": "MG",
    "PARA": "PA",
    "PARAIBA": "PB",
    "PARANA": "PR",
    "PERNAMBUCO": "PE",
    "PIAUI": "PI",
    "RIO DE JANEIRO": "RJ",
    "RIO GRANDE DO NORTE": "RN",
    "RIO GRANDE DO SUL": "RS",
    "RONDONIA": "RO",
    "RORAIMA": "RR",
    "SANTA CATARINA": "SC",
    "SAO PAULO": "SP",
    "SERGIPE": "SE",
    "TOCANTINS": "TO",
}


def null_outside(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """``value``, or null where it lies below ``low`` or above ``high`` (limits stay)."""
    outside = F.lit(False)
    if low is not None:
        outside = outside | (value < low)
    if high is not None:
        outside = outside | (value > high)
    return F.when(outside, F.lit(None)).otherwise(value)


def band(value: Column, bands: Sequence[tuple[float, str]] = RISK_BANDS, otherwise: str = NO_BAND) -> Column:
    """Name of the first band whose upper limit is not exceeded; null and above-all go to ``otherwise``."""
    chain = None
    for limit, name in bands:
        hit = value <= limit
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain.otherwise(otherwise)


def within(value: Column, low: float, high: float) -> Column:
    """True inside the inclusive range, false outside it and for null."""
    return F.coalesce(value.between(low, high), F.lit(False))


def coordinate_flags(lat: Column, lon: Column) -> dict[str, Column]:
    """The three validity columns of a latitude and longitude."""
    lat_ok, lon_ok = within(lat, -90, 90), within(lon, -180, 180)
    return {"valid_lat": lat_ok, "valid_lon": lon_ok, "valid_coordinates": lat_ok & lon_ok}


def code_of(name: Column, codes: Mapping[str, str] = STATE_CODES) -> Column:
    """Code of a name by a literal map; null for unknown and null names."""
    entries = [F.lit(part) for pair in codes.items() for part in pair]
    return F.create_map(*entries)[name]
