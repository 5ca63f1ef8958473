"""Exact median per group, for groups of any size.

Spark's own ``median`` holds every distinct value of a group in one buffer. Here three passes
narrow a group down before its values meet in one task:

1. a quantile sketch brackets the middle of each group;
2. a histogram inside the bracket, with one bucket for all below and one for all above, gives
   exact ranks and so the bucket of the median, also should the bracket have missed it;
3. the distinct values of that bucket are counted and ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.session import stored

ACCURACY = 10_000
BUCKETS = 1_000


def _bucket(value: Column) -> Column:
    """-1 below the bracket, BUCKETS + 1 above it; never falls as the value rises."""
    share = F.coalesce(F.try_divide(value - F.col("lo"), F.col("hi") - F.col("lo")), F.lit(0.0))
    return (F.when(value < F.col("lo"), -1).when(value > F.col("hi"), BUCKETS + 1)
            .otherwise(F.floor(share * BUCKETS).cast("int")))


def exact_median(df: DataFrame, by: str, columns: list[str], more: Sequence[Column] = ()) -> DataFrame:
    """``by``, the aggregates ``more`` and ``median_<column>`` for each column; NULL and NaN values do not count.

    ``more`` come out of the first pass, so the input is read three times in all. Groups without any value
    are left out unless there are such aggregates. Runs two small jobs when called: the brackets and the target
    buckets (a row per group) are stored, so that their size is known to the joins that read them.
    """
    rows = df.where(F.col(by).isNotNull())
    values = (
        rows
        .select(F.col(by).alias("group"), F.explode(F.array(*[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
            for c in columns])).alias("v"))
        .select("group", "v.*").where("value is not null and not isnan(value)")
    )
    key = ["group", "metric"]
    margin = 2 / ACCURACY
    known = {c: F.nullif(F.col(c).cast("double"), F.lit(float("nan"))) for c in columns}
    wide = stored(rows.groupBy(F.col(by).alias("group")).agg(*more, *[part for c, value in known.items() for part in (
        F.count(value).alias(f"_n_{c}"),
        F.percentile_approx(value, [0.5 - margin, 0.5 + margin], ACCURACY).alias(f"_q_{c}"))]), "median-brackets")
    bracket = wide.select("group", F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(f"_n_{c}").alias("n"), F.col(f"_q_{c}").alias("q"))
        for c in columns])).alias("b")).where("b.n > 0").select(
            "group", "b.metric", "b.n", F.col("b.q")[0].alias("lo"), F.col("b.q")[1].alias("hi"))

    placed = values.join(bracket, key).withColumn("bucket", _bucket(F.col("value")))
    histogram = placed.groupBy(*key, "n", "lo", "hi", "bucket").agg(F.count("*").alias("size"))
    upto = Window.partitionBy(*key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    n = F.col("n")
    low_rank, high_rank = F.floor((n + 1) / 2), F.floor(n / 2) + 1
    upper = F.col("upper")
    target = (
        histogram.withColumn("upper", F.sum("size").over(upto))
        .withColumn("before", upper - F.col("size"))
        .where(((upper >= low_rank) & (F.col("before") < low_rank))
               | ((upper >= high_rank) & (F.col("before") < high_rank)))
        .select(*key, "n", "lo", "hi", "bucket", "before")
    )
    target = stored(target, "median-targets")

    counts = (
        values.join(target, key).where(_bucket(F.col("value")) == F.col("bucket"))
        .groupBy(*key, "n", "bucket", "before", "value").agg(F.count("*").alias("size"))
    )
    within = (Window.partitionBy(*key, "bucket").orderBy("value")
              .rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumn("upper", F.col("before") + F.sum("size").over(within))
    medians = ranked.groupBy(*key).agg(
        ((F.min(F.when(upper >= low_rank, F.col("value")))
          + F.min(F.when(upper >= high_rank, F.col("value")))) / 2).alias("median"))
    flat = medians.groupBy("group").agg(*[
        F.max(F.when(F.col("metric") == c, F.col("median"))).alias(f"median_{c}") for c in columns])
    if more:
        flat = wide.drop(*[f"_{x}_{c}" for x in "nq" for c in columns]).join(flat, "group", "left")
    return flat.withColumnRenamed("group", by)
