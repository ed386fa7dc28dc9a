"""The stages as commands over one lake: ``python -m emberlake.jobs --lake ROOT STAGE``.

Each stage reads the tables of the one before, may be run again, and runs under
spark-submit as well.
"""

from __future__ import annotations

import argparse
import datetime
import getpass
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from emberlake.operators.shaping import union_by_name
from emberlake.plans.dimensions import build_dimension, clean_layer, extend_date_dimension
from emberlake.plans.fact import refresh_fact
from emberlake.plans.hotspots import clean_hotspots, load_hotspots, read_feeds
from emberlake.plans.ingest import ingest
from emberlake.plans.serving import publish
from emberlake.schemas import (
    BIOME_DIMENSION,
    BIOME_LAYER,
    MUNICIPALITY_DIMENSION,
    MUNICIPALITY_LAYER,
    RAW_HOTSPOT,
    SERVING,
    YEARLY_NAMES,
)
from emberlake.session import build_session, fit_shuffles
from emberlake.sinks.tables import overwrite_table
from emberlake.sources.files import read_csv
from emberlake.sources.layers import read_layer
from emberlake.sources.tables import read_table, table_exists


@dataclass(frozen=True)
class Lake:
    """Where the layers of a lake lie."""

    root: str

    def raw(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/raw/{name}"

    def trusted(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/trusted/{name}"

    def refined(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/refined/{name}"


# Area layers: raw and trusted name, layer columns, dimension name, dimension columns.
AREAS = (
    ("municipalities", MUNICIPALITY_LAYER, "dm_municipio", MUNICIPALITY_DIMENSION),
    ("biome", BIOME_LAYER, "dm_bioma", BIOME_DIMENSION),
)


def hotspots(spark: SparkSession, lake: Lake, null_token: str | None = None) -> None:
    """New daily files into the trusted table; the first run takes monthly and yearly files too."""
    table = lake.trusted("hotspots")

    def load(rows: DataFrame) -> None:
        if not table_exists(spark, table):
            history = {"monthly": None, "yearly": YEARLY_NAMES}
            parts = {n: names for n, names in history.items() if table_exists(spark, lake.raw(f"hotspots/{n}"))}
            frames = [read_csv(spark, lake.raw(f"hotspots/{n}"), list(RAW_HOTSPOT), names) for n, names in parts.items()]
            rows = union_by_name(rows, *frames)
        load_hotspots(clean_hotspots(rows, null_token), table, whole_rows_keyed=null_token is not None)

    parts = ("daily",) if table_exists(spark, table) else ("daily", "monthly", "yearly")
    fit_shuffles(spark, *[lake.raw(f"hotspots/{n}") for n in parts])
    ingest(spark, lake.raw("hotspots/daily"), lake.raw("hotspots/date_control"), load)


def reload_hotspots(spark: SparkSession, lake: Lake, null_token: str | None = None) -> None:
    """All daily files into the trusted table, whatever the mark says."""
    fit_shuffles(spark, lake.raw("hotspots/daily"))
    rows = clean_hotspots(read_feeds(spark, lake.raw("hotspots/daily")), null_token)
    load_hotspots(rows, lake.trusted("hotspots"), whole_rows_keyed=null_token is not None)


def areas(spark: SparkSession, lake: Lake) -> None:
    """Municipality and biome layers into trusted tables and dimensions."""
    for name, layer, dimension, columns in AREAS:
        overwrite_table(clean_layer(read_layer(spark, lake.raw(name)), layer), lake.trusted(name))
        overwrite_table(build_dimension(read_table(spark, lake.trusted(name)), columns), lake.refined(dimension))


def dates(spark: SparkSession, lake: Lake, as_of: datetime.date) -> None:
    """The date dimension up to ``as_of``."""
    extend_date_dimension(spark, lake.refined("dm_data"), as_of)


def fact(spark: SparkSession, lake: Lake) -> None:
    """The fact table, after the date dimension has caught up with the hotspots."""
    fit_shuffles(spark, lake.trusted("hotspots"))
    dimensions = (lake.refined(n) for n in ("dm_data", "dm_municipio", "dm_bioma"))
    refresh_fact(spark, lake.trusted("hotspots"), *dimensions, lake.refined("ft_queimada"))


def serve(spark: SparkSession, lake: Lake, connection: Mapping[str, str]) -> None:
    """The four refined tables into the serving database."""
    for name, table in SERVING.items():
        publish(read_table(spark, lake.refined(name)), table, connection)


def _password(path: str | None) -> str:
    """The password from a file or a prompt; as an argument it would show in process lists."""
    return Path(path).read_text().strip() if path else getpass.getpass("Database password: ")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="emberlake.jobs", description=__doc__)
    parser.add_argument("--lake", required=True, help="root folder of the lake")
    stages = parser.add_subparsers(dest="stage", required=True)
    for name in ("hotspots", "reload"):
        stages.add_parser(name).add_argument("--null-token", help="keep nulls apart in row keys")
    stages.add_parser("areas")
    stages.add_parser("dates").add_argument("--as-of", type=datetime.date.fromisoformat, required=True)
    stages.add_parser("fact")
    server = stages.add_parser("serve")
    for option in ("url", "user", "driver"):
        server.add_argument(f"--{option}", required=True)
    server.add_argument("--password-file", help="file that holds the password; asked for if not given")
    server.add_argument("--connections", help="how many tasks write at the same time; one a partition if not given")
    chosen = parser.parse_args(arguments)

    spark, lake = build_session(f"emberlake-{chosen.stage}"), Lake(chosen.lake)
    if chosen.stage == "hotspots":
        hotspots(spark, lake, chosen.null_token)
    elif chosen.stage == "reload":
        reload_hotspots(spark, lake, chosen.null_token)
    elif chosen.stage == "areas":
        areas(spark, lake)
    elif chosen.stage == "dates":
        dates(spark, lake, chosen.as_of)
    elif chosen.stage == "fact":
        fact(spark, lake)
    else:
        connection = {o: getattr(chosen, o) for o in ("url", "user", "driver")} | {"password": _password(chosen.password_file)}
        serve(spark, lake, connection | ({"numPartitions": chosen.connections} if chosen.connections else {}))


if __name__ == "__main__":
    main()
