"""Property graph as node / edge DataFrames: merges, upserts, deletes.

MERGE-with-ON-CREATE (first write wins) becomes ``merge_insert``; MERGE-then-
SET (last write wins) becomes ``upsert_latest``.  Both resolve duplicates per key
with a ``min_by`` / ``max_by`` aggregate: Spark runs it as a partial aggregate on
the map side, so a key holding a third of all rows is reduced to one row per
map task before the shuffle - no group is ever collected into one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def null_key_filter(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def rejects(df: DataFrame, keys) -> DataFrame:
    """Rows a MERGE would fail on (null key); routed aside instead of failing a batch."""
    keys = _names(keys)
    return df.filter(~null_key_filter(keys))


_FIXED_WIDTH = ("boolean", "byte", "short", "integer", "long", "float", "double", "date", "timestamp", "timestamp_ntz")


def first_per_key(df: DataFrame, keys, order, values=None) -> DataFrame:
    """One row per key: the row with the smallest ``order`` (deterministic survivor).

    ``values`` defaults to every non-key column.  Rows with a null key are dropped
    (see ``rejects``).  Values of fixed width are picked by one ``min_by`` each, which
    a hash aggregate can hold; others travel as one struct, which sorts.
    """
    keys, order = _names(keys), _names(order)
    values = [c for c in (values or df.columns) if c not in keys]
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    rows = df.filter(null_key_filter(keys)).groupBy(*keys)
    if len(order) == 1 and all(kinds[c] in _FIXED_WIDTH for c in [*values, *order]):
        return rows.agg(*[F.min_by(c, order[0]).alias(c) for c in values])
    packed = F.struct(*[F.col(c) for c in values])
    by = F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])
    return rows.agg(F.min_by(packed, by).alias("_v")).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def last_per_key(df: DataFrame, keys, order, values=None) -> DataFrame:
    """One row per key: the row with the largest ``order`` (last write wins)."""
    keys, order = _names(keys), _names(order)
    values = [c for c in (values or df.columns) if c not in keys]
    packed = F.struct(*[F.col(c) for c in values])
    by = F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])
    grouped = df.groupBy(*keys) if keys else df.groupBy()
    out = grouped.agg(F.max_by(packed, by).alias("_v"))
    return out.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def insert_if_absent(incoming: DataFrame, target: DataFrame | None, keys, order,
                     values=None) -> DataFrame:
    """MERGE ... ON CREATE SET: the rows of ``incoming`` whose key ``target`` lacks.

    Returns only the new rows (to append).  The anti-join reads just the key
    columns of the target, so its cost is one key column, not the whole table.
    """
    keys = _names(keys)
    new = first_per_key(incoming, keys, order, values)
    if target is None:
        return new
    return new.join(target.select(*keys), on=keys, how="left_anti")


def merge_insert(incoming: DataFrame, target: DataFrame | None, keys, order,
                 values=None) -> DataFrame:
    """Target after an insert-only merge (existing rows win, new keys appended)."""
    new = insert_if_absent(incoming, target, keys, order, values)
    if target is None:
        return new
    return target.unionByName(new.select(*target.columns))


def upsert_latest(incoming: DataFrame, target: DataFrame | None, keys, order,
                  values=None) -> DataFrame:
    """MERGE ... SET: each key keeps the version with the greatest ``order``."""
    keys, order = _names(keys), _names(order)
    both = incoming if target is None else target.unionByName(incoming.select(*target.columns))
    return last_per_key(both, keys, order, values)


def distinct_edges(df: DataFrame, keys) -> DataFrame:
    """MERGE of a relationship without properties to set: distinct key tuples."""
    keys = _names(keys)
    return df.filter(null_key_filter(keys)).select(*keys).distinct()


def detach_delete(nodes: DataFrame, key: str, edges: dict[str, tuple[DataFrame, list[str]]],
                  victims: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """DETACH DELETE: drop ``victims`` (a one-column key frame) from nodes and from
    every edge table at each end that references the label.

    ``edges`` maps a name to (edge frame, [columns holding this label's key]).
    """
    v = victims.select(F.col(key))
    kept_nodes = nodes.join(v, on=key, how="left_anti")
    kept_edges = {}
    for name, (e, cols) in edges.items():
        out = e
        for c in cols:
            out = out.join(v.withColumnRenamed(key, c), on=c, how="left_anti")
        kept_edges[name] = out
    return kept_nodes, kept_edges
