"""Presence of keys across several tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionweave.operators.filters import query_tables

_BITS = 62  # tables whose presence shares one number


def presence(tables: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row per key that is in any table, with a boolean column per table.

    Nulls in a key are equal to each other.  Each table adds its bit in the map tasks, so
    repeated keys need no distinct of their own.
    """
    if not tables:
        raise ValueError("no tables")
    if clash := set(tables) & set(keys):
        raise ValueError(f"table names equal to key names: {sorted(clash)}")
    tagged, words = None, -(-len(tables) // _BITS)
    for i, table in enumerate(tables.values()):
        own = [F.lit((1 << i % _BITS) * (i // _BITS == w)).cast("bigint").alias(f"_bits{w}") for w in range(words)]
        part = table.select(*keys, *own)
        tagged = part if tagged is None else tagged.unionAll(part)
    per_key = tagged.groupBy(*keys).agg(*[F.bit_or(f"_bits{w}").alias(f"_bits{w}") for w in range(words)])

    def present(i: int):
        return F.getbit(F.col(f"_bits{i // _BITS}"), F.lit(i % _BITS)) == 1

    return per_key.select(
        *keys,
        *[present(i).alias(n) for i, n in enumerate(tables)],
    )


def presence_counts(tables: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Number of distinct keys per combination of tables; only combinations that occur."""
    return presence(tables, keys).groupBy(*tables).agg(F.count(F.lit(1)).alias("count"))


def named_tables(tables: Sequence[DataFrame], names: Sequence[str]) -> dict[str, DataFrame]:
    """Tables under display names; raises on repeated names or unequal lengths."""
    if len(set(names)) != len(names):
        raise ValueError("display names repeat")
    return dict(zip(names, tables, strict=True))


def presence_counts_by_sql(tables: Mapping[str, DataFrame], sqls: Mapping[str, str]) -> DataFrame:
    """Presence counts for each titled key query; ``{table}`` in the SQL is one table.

    Columns: ``sql`` (the title), one boolean per table, ``count``.
    """
    out = None
    for title, sql in sqls.items():
        keyed = {name: query_tables(sql, table=table) for name, table in tables.items()}
        columns = next(iter(keyed.values())).columns
        keys = [f"_key{i}" for i in range(len(columns))]
        keyed = {name: df.toDF(*keys) for name, df in keyed.items()}
        block = presence_counts(keyed, keys).select(F.lit(title).alias("sql"), *tables, "count")
        out = block if out is None else out.unionByName(block)
    return out


def keys_in_pattern(flags: DataFrame, pattern: Mapping[str, bool], keys: Sequence[str]) -> DataFrame:
    """Keys with the given presence: an intersection or difference of the tables."""
    for name, wanted in pattern.items():
        flags = flags.where(F.col(name) if wanted else ~F.col(name))
    return flags.select(*keys)
