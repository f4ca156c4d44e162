"""A current database for unqualified table names, for as long as a block runs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def current_database(spark: SparkSession, name: str | None) -> Iterator[None]:
    """Unqualified names mean tables of ``name`` (``database`` or ``catalog.database``) here.

    What was current before is current again afterwards, also after an error.  ``None``
    changes nothing.  Frames resolve their names when they are made, so those made inside
    may be used outside.
    """
    if name is None:
        yield
        return
    before = spark.catalog.currentCatalog(), spark.catalog.currentDatabase()
    catalog, _, database = name.rpartition(".")
    try:
        if catalog:
            spark.catalog.setCurrentCatalog(catalog)
        spark.catalog.setCurrentDatabase(database)
        yield
    finally:
        spark.catalog.setCurrentCatalog(before[0])
        spark.catalog.setCurrentDatabase(before[1])


def qualified(spark: SparkSession, name: str) -> str:
    """``name`` as it is found now: temporary views first, then the current database."""
    if "." in name or _is_temporary(spark, name):
        return name
    return f"{spark.catalog.currentCatalog()}.{spark.catalog.currentDatabase()}.{name}"


def _is_temporary(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary
