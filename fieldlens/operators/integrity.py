"""Constraint checks that Parquet does not enforce, as (table, check, column, violations) rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.sources.schemas import LINKS, Link, Table

REPORT = "table_name string, check_name string, column_name string, violations bigint"


def _row_checks(frame: DataFrame, table: Table) -> DataFrame | None:
    """Every single-row rule of a table in one scan and one aggregate."""
    checks = []
    for f in table.fields:
        if f.name not in frame.columns:
            continue
        c = F.col(f.name)
        if f.required:
            checks.append(("not_null", f.name, F.count_if(c.isNull())))
        if f.max_len is not None:
            checks.append(("max_length", f.name, F.count_if(F.length(c) > f.max_len)))
        if isinstance(f.type, T.DecimalType):
            fits = F.expr(f"try_cast(`{f.name}` as {f.type.simpleString()})")
            checks.append(("precision", f.name, F.count_if(c.isNotNull() & fits.isNull())))
    if not checks:
        return None
    rows = F.array(
        *[
            F.struct(
                F.lit(table.name).alias("table_name"),
                F.lit(kind).alias("check_name"),
                F.lit(col).alias("column_name"),
                count.alias("violations"),
            )
            for kind, col, count in checks
        ]
    )
    return frame.agg(rows.alias("r")).select(F.inline("r"))


def _unique_check(frame: DataFrame, table: Table, column: str) -> DataFrame:
    """Values that occur more than once; NULLs may repeat."""
    repeated = frame.where(F.col(column).isNotNull()).groupBy(column).count().where("count > 1")
    return repeated.agg(F.count("*").alias("violations")).select(
        F.lit(table.name).alias("table_name"),
        F.lit("unique").alias("check_name"),
        F.lit(column).alias("column_name"),
        "violations",
    )


def _link_check(frames: Mapping[str, DataFrame], link: Link, parent_key: str) -> DataFrame:
    """Rows whose reference points nowhere, counted per value before the join."""
    refs = (
        frames[link.child].where(F.col(link.column).isNotNull()).groupBy(F.col(link.column).alias("_ref")).count()
    )
    parents = frames[link.parent].select(F.col(parent_key).alias("_key"))
    return (
        refs.join(parents, F.col("_ref") == F.col("_key"), "left_anti")
        .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("violations"))
        .select(
            F.lit(link.child).alias("table_name"),
            F.lit("foreign_key").alias("check_name"),
            F.lit(link.column).alias("column_name"),
            "violations",
        )
    )


def integrity_report(
    frames: Mapping[str, DataFrame], tables: Mapping[str, Table], links: Iterable[Link] = LINKS
) -> DataFrame:
    parts: list[DataFrame] = []
    for name, frame in frames.items():
        table = tables[name]
        rows = _row_checks(frame, table)
        if rows is not None:
            parts.append(rows)
        for column in (table.key, *table.unique):
            if column in frame.columns:
                parts.append(_unique_check(frame, table, column))
    for link in links:
        if link.child in frames and link.parent in frames:
            parts.append(_link_check(frames, link, tables[link.parent].key))
    return reduce(DataFrame.unionByName, parts)
