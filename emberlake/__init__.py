"""Event lakehouse and star-schema analytics as Spark jobs.

Layers: ``sources`` read files and tables, ``functions`` are column
expressions, ``operators`` combine DataFrames, ``sinks`` write tables,
``plans`` are the jobs a user calls and ``streaming`` runs the daily load as a
file stream.
"""

from emberlake.session import build_session

__all__ = ["build_session"]
