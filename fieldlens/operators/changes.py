"""Batches of inserts, updates and deletes applied to a table, giving its next version.

Parquet tables are immutable, so each job returns a new frame. All column names are
checked against the declared schema. Where a batch may name a key more than once, the
latest change is chosen by an aggregate, which combines on the map side and keeps a key
that fills a third of the batch from landing in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.sources.schemas import LINKS, Link, Table


def insert_rows(frame: DataFrame, rows: DataFrame, table: Table) -> DataFrame:
    """Append rows; a column the batch does not carry gets its default, else NULL."""
    for name in rows.columns:
        table.check_column(name)
    given = set(rows.columns)
    filled = rows.select(
        *[
            (F.col(f.name).cast(f.type) if f.name in given else f.default_column()).alias(f.name)
            for f in table.fields
            if f.name in frame.columns
        ]
    )
    return frame.unionByName(filled)


def _hit(column: str, value: object) -> Column:
    return F.coalesce(F.col(column) == F.lit(value), F.lit(False))


def update_where(
    frame: DataFrame, table: Table, set_column: str, new_value: object, where_column: str, where_value: object
) -> DataFrame:
    """Set one column on the rows where another equals a value."""
    table.check_column(set_column)
    table.check_column(where_column)
    kind = frame.schema[set_column].dataType
    return frame.withColumn(
        set_column,
        F.when(_hit(where_column, where_value), F.lit(new_value).cast(kind)).otherwise(F.col(set_column)),
    )


def delete_where(frame: DataFrame, table: Table, where_column: str, where_value: object) -> DataFrame:
    """Drop rows where a column equals a value; rows with NULL there stay."""
    table.check_column(where_column)
    return frame.where(~_hit(where_column, where_value))


def count_where(frame: DataFrame, table: Table, where_column: str, where_value: object) -> DataFrame:
    """The number of rows an update or delete touches, as a one-row frame."""
    table.check_column(where_column)
    return frame.agg(F.count_if(_hit(where_column, where_value)).alias("affected"))


def latest(changes: DataFrame, key: str, order: str) -> DataFrame:
    """The last change per key; equal order values fall back to comparing the row itself."""
    rest = [c for c in changes.columns if c not in (key, order)]
    return (
        changes.groupBy(key)
        .agg(F.max(F.struct(F.col(order), *[F.col(c) for c in rest])).alias("_last"))
        .select(key, F.col("_last")[order].alias(order), *[F.col("_last")[c].alias(c) for c in rest])
    )


def update_batch(frame: DataFrame, table: Table, changes: DataFrame, order: str | None = None) -> DataFrame:
    """Overwrite columns from a batch of (key, new values); keys without a row are ignored.

    Where a key is repeated its last change by ``order`` counts; without an order the greatest
    row, so that a repeat never multiplies rows of the table.
    """
    key = table.key
    values = [c for c in changes.columns if c not in (key, order)]
    for name in values:
        table.check_column(name)
    changes = changes.groupBy(key).agg(F.max(F.struct(*values)).alias("_last")).select(key, "_last.*") if order is None else latest(changes, key, order)
    new = changes.select(
        F.col(key).alias("_key"), F.struct(*[F.col(c).cast(frame.schema[c].dataType).alias(c) for c in values]).alias("_new")
    )
    hit = F.col("_key").isNotNull()
    return frame.join(new, F.col(key) == F.col("_key"), "left").select(
        *[
            (F.when(hit, F.col("_new")[c]).otherwise(F.col(c)) if c in values else F.col(c)).alias(c)
            for c in frame.columns
        ]
    )


def delete_batch(frame: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Drop the rows whose column matches a key; NULLs never match and stay."""
    doomed = keys.select(F.col(keys.columns[0]).alias("_key"))
    return frame.join(doomed, F.col(column) == F.col("_key"), "left_anti")


def upsert(frame: DataFrame, changes: DataFrame, table: Table, action: str = "action", order: str = "seq") -> DataFrame:
    """Apply a mixed batch in one pass.

    ``changes`` has the table's columns plus an action (insert, update, delete) and an
    order. Per key the last change counts: insert and update leave the given row (an
    update of a key that does not exist is ignored), delete leaves none.
    """
    key = table.key
    new = latest(changes, key, order)
    n = new.select(F.col(key).alias("_key"), F.col(action).alias("_act"), F.struct(*frame.columns).alias("_new"))
    joined = frame.withColumn("_old", F.lit(True)).join(n, F.col(key) == F.col("_key"), "full")
    kept = joined.where(
        F.col("_act").isNull()
        | (F.col("_act") == "insert")
        | ((F.col("_act") == "update") & F.col("_old").isNotNull())
    )
    return kept.select(
        *[F.when(F.col("_act").isNull(), F.col(c)).otherwise(F.col("_new")[c]).alias(c) for c in frame.columns]
    )


def delete_with_rules(
    frames: Mapping[str, DataFrame],
    name: str,
    doomed: DataFrame,
    tables: Mapping[str, Table],
    links: Iterable[Link] = LINKS,
) -> dict[str, DataFrame]:
    """Delete keys from one table and follow the foreign keys below it.

    Children under a cascade rule go too, level by level; children under a set-null rule
    keep their row and lose the reference.
    """
    links = tuple(links)
    out = dict(frames)
    level = [(name, doomed.select(F.col(doomed.columns[0]).alias("_key")).distinct())]
    while level:
        table, keys = level.pop(0)
        out[table] = out[table].join(keys, F.col(tables[table].key) == F.col("_key"), "left_anti")
        for link in links:
            if link.parent != table or link.child not in out:
                continue
            child = out[link.child]
            if link.rule == "cascade" and link.column == tables[link.child].key and all(other.parent != link.child for other in links):
                # the child goes by the same column and nothing hangs on it: keys that it lacks delete nothing
                level.append((link.child, keys))
            elif link.rule == "cascade":
                below = child.join(keys, F.col(link.column) == F.col("_key"), "left_semi")
                level.append((link.child, below.select(F.col(tables[link.child].key).alias("_key")).distinct()))
            else:
                out[link.child] = child.join(keys, F.col(link.column) == F.col("_key"), "left").select(
                    *[
                        (F.when(F.col("_key").isNull(), F.col(c)) if c == link.column else F.col(c)).alias(c)
                        for c in child.columns
                    ]
                )
    return out
