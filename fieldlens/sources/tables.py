"""Register tables at rest: one Parquet directory per table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from fieldlens.sources.schemas import REGISTER, Table


def read_table(spark: SparkSession, directory: str, name: str, tables: Mapping[str, Table] = REGISTER) -> DataFrame:
    """One whole table under its declared schema; an unknown name raises."""
    if name not in tables:
        raise ValueError(f"unknown table {name!r}; known: {sorted(tables)}")
    return spark.read.schema(tables[name].struct).parquet(f"{directory}/{name}")


def read_register(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """All six register tables, lazily."""
    return {name: read_table(spark, directory, name) for name in REGISTER}


def write_table(frame: DataFrame, directory: str, name: str) -> None:
    """Write a table version into a directory that must not exist yet."""
    frame.write.mode("errorifexists").parquet(f"{directory}/{name}")
