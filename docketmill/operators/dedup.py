"""First-wins and last-wins deduplication by an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _winner(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    # A partial aggregate keeps one row for each key and task before the shuffle, which a window would not.
    rest = [c for c in df.columns if c not in order]
    packed = F.struct(*[F.col(c) for c in [*order, *rest]])
    return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(pick(packed).alias("_w")).select(*[F.col(f"_w.{c}").alias(c) for c in df.columns])


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by order; order must tell rows apart, its types must be orderable."""
    return _winner(df, keys, order, F.min)


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _winner(df, keys, order, F.max)


def drop_blank_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys trimmed, rows with blank ones gone."""
    return df.withColumn(key, F.trim(F.col(key))).filter(F.coalesce(F.col(key), F.lit("")) != "")


def collect_in_order(value: Column, order: Column) -> Column:
    """Aggregate: distinct non-blank values in the order in which they first come."""
    kept = F.collect_list(F.when(value.isNotNull() & (value != ""), F.struct(order.alias("o"), value.alias("v"))))
    return F.array_distinct(F.transform(F.array_sort(kept), lambda x: x["v"]))
