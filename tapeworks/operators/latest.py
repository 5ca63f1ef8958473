"""Newest row per key and duplicate removal, without sorting the whole input.

The greatest time per key is a hash aggregate of one fixed-width value, combined on the map side. It is stored, so
that Spark knows its size: a small one is broadcast and the input is not shuffled again. Only rows at that time are
compared as a whole.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tapeworks.session import stored


def matching(keys: list[str], prefix: str = "_of_") -> Column:
    """Equality of ``keys`` with their namesakes behind ``prefix``; NULL equals NULL."""
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def prefixed(df: DataFrame, keys: list[str], prefix: str = "_of_") -> DataFrame:
    return df.withColumnsRenamed({k: f"{prefix}{k}" for k in keys})


def last_times(df: DataFrame, keys: list[str], times: dict[str, Column]) -> DataFrame:
    """Stored table of the greatest value of each of ``times`` per key."""
    return stored(df.groupBy(*keys).agg(*[F.max(c).alias(n) for n, c in times.items()]), "last-times")


def at_last(df: DataFrame, keys: list[str], time: str, last: DataFrame, name: str) -> DataFrame:
    """Rows of ``df`` whose time is that of their key in the column ``name`` of ``last``."""
    known = prefixed(last.select(*keys, F.col(name).alias("_last")), keys)
    return df.join(known, matching(keys) & F.col(time).eqNullSafe(F.col("_last")), "left_semi")


def _orderable(df: DataFrame, columns: list[str]) -> list[Column]:
    """Columns that can be compared: maps as sorted lists of their entries."""
    return [(F.array_sort(F.map_entries(c)) if isinstance(df.schema[c].dataType, MapType) else F.col(c)).alias(c)
            for c in columns]


def greatest_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """The row with the greatest values per key. Sorts its input."""
    rest = [c for c in df.columns if c not in keys]
    row = df.groupBy(*keys).agg(F.max(F.struct(*_orderable(df, rest))).alias("_row"))
    back = [(F.map_from_entries(f"_row.{c}") if isinstance(df.schema[c].dataType, MapType) else F.col(f"_row.{c}"))
            .alias(c) for c in rest]
    return row.select(*keys, *back).select(*df.columns)


def newest_rows(df: DataFrame, keys: list[str], time: str) -> DataFrame:
    """The whole newest row per key. Of rows at the same time the one with the greatest values stays."""
    last = last_times(df, keys, {"last": F.col(time)})
    return greatest_rows(at_last(df, keys, time, last, "last"), keys)


def newest_values(df: DataFrame, keys: list[str], time: str, columns: list[str], place: str | None = None) -> DataFrame:
    """Last known value of each of the fixed-width ``columns`` per key, column by column.

    Of values at the same time the one of the least ``place`` counts, without a place the greatest.
    """
    last = last_times(df, keys, {c: F.when(F.col(c).isNotNull(), F.col(time)) for c in columns})
    known = prefixed(last, [*keys, *columns])
    joined = df.select(*keys, time, *columns, *([place] if place else [])).join(known, matching(keys))
    here = {c: F.col(time) == F.col(f"_of_{c}") for c in columns}
    if place:
        # Only rows that may be picked are sorted, and those of keys without any value.
        joined = joined.where(reduce(or_, here.values()) | F.coalesce(*[f"_of_{c}" for c in columns]).isNull())
        picks = [F.min_by(c, F.when(here[c] & F.col(c).isNotNull(), F.col(place))).alias(c) for c in columns]
    else:
        picks = [F.max(F.when(here[c], F.col(c))).alias(c) for c in columns]
    return joined.groupBy(*keys).agg(*picks)


def dedupe(df: DataFrame, keys: tuple[str, ...] = ("symbol", "quote_timestamp"),
           watermark: str | None = None) -> DataFrame:
    """One row per key.

    A batch keeps the greatest row, so reruns agree; only keys that occur more than once are compared.
    A stream keeps the first to arrive; with a ``watermark`` delay its state is dropped once no duplicate
    can come any more.
    """
    if df.isStreaming:
        if watermark is None:
            return df.dropDuplicates(list(keys))
        return df.withWatermark(keys[-1], watermark).dropDuplicatesWithinWatermark(list(keys))
    names = list(keys)
    twice = stored(df.groupBy(*names).agg(F.count("*").alias("_n")).where("_n > 1").select(*names), "repeated-keys")
    twice = prefixed(twice, names)
    same = matching(names)
    return df.join(twice, same, "left_anti").unionByName(
        greatest_rows(df.join(twice, same, "left_semi"), names))
