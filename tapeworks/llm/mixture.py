"""Mixing sources to target weights by Sainte-Laguë apportionment. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import stored, word_count


def sums_before(rows: DataFrame, order: Sequence[Column], sums: dict[str, Column],
                range_rows: int = 100_000) -> DataFrame:
    """``rows`` with the sums of columns over all rows before each in ``order``, and ``place``, their number.

    ``order`` is total. Rows are dealt by sampled bounds over ranges of about ``range_rows``; sums run within a range,
    and one row per range is added up over all of them, so no task holds all rows.
    """
    sums = sums | {"place": F.lit(1).cast("long")}
    ranges = rows.count() // range_rows + 1
    dealt = stored(rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ordered")
    totals = dealt.groupBy("_range").agg(*[F.sum(c).alias(f"_{name}") for name, c in sums.items()])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(totals.select("_range", *[F.sum(f"_{name}").over(earlier).alias(f"_{name}") for name in sums]),
                   "ordered-bases")
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    none = {name: F.lit(0).cast(totals.schema[f"_{name}"].dataType) for name in sums}
    summed = dealt.withColumns({f"_at_{name}": F.sum(c).over(within) for name, c in sums.items()})
    return summed.join(bases, "_range").withColumns(
        {name: F.coalesce(f"_at_{name}", none[name]) + F.coalesce(f"_{name}", none[name]) for name in sums}) \
        .select(*rows.columns, *sums)


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0,
                   share: float = 1.0) -> DataFrame:
    """Target of each source: ``sizes`` has one row per source (source, source_size).

    Sources in code-point order, NULL last, get the weights in turn. Targets share ``share`` of all
    sizes by weight; none is above ``most`` times its source, and what is above goes to the others by
    weight. So the sources with the least size per weight are full, and the others share the rest: in
    that order, a source is full if the level that would be left for it exceeds its own limit.
    """
    placed = sums_before(sizes.select("source", "source_size"), [F.col("source").asc_nulls_last()], {})
    values = F.array(*[F.lit(float(w)) for w in weights])
    rows = (placed.withColumn("weight", F.get(values, (F.col("place") % len(weights)).cast("int"))).drop("place")
            .withColumn("cap", F.col("source_size") * float(most)))
    rows = stored(rows, "source-weights")
    goal = rows.agg(F.sum("source_size") * float(share)).scalar()
    weight_left = rows.agg(F.sum("weight")).scalar() - F.col("weights_before")
    order = [(F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    rows = sums_before(rows, order, {"caps_before": F.col("cap"), "weights_before": F.col("weight")}).drop("place")
    rows = rows.withColumn("level", F.try_divide(goal - F.col("caps_before"), weight_left))
    rows = stored(rows.withColumn("full", F.col("cap") <= F.col("level") * F.col("weight")), "source-levels")
    # After the first source that is not full, the levels fall: its level holds for all of them.
    level = rows.agg(F.max(F.when(~F.col("full"), F.col("level")))).scalar()
    return rows.select("source", "source_size", "weight",
                       F.when(F.col("full"), F.col("cap")).otherwise(F.least(
                           F.col("cap"), level * F.col("weight"))).alias("target"))


def sainte_lague(parties: DataFrame, group: Sequence[str], votes: str, seats: str, party: Sequence[str],
                 most: str, out: str) -> DataFrame:
    """Give ``seats`` of each group to its parties by the highest quotients votes / (2 k + 1).

    Rounding votes against the average price of a seat, moved by half a seat per party up or down, gives
    for each party seats that it gets in any case and a few that it may get; only those are ranked.
    ``most`` caps a party's seats. Ties go to the parties first in order. Without a ``group``, all parties
    are ranked over ranges of quotients, else each group in one task.
    """
    if group:
        whole = Window.partitionBy(*group)
        over = lambda rows, c: c.over(whole)
    else:
        parties = stored(parties, "parties")
        over = lambda rows, c: rows.agg(c).scalar()
    v, total, n = F.col(votes), over(parties, F.sum(votes)), over(parties, F.count("*"))
    at = lambda count: F.floor(F.coalesce(F.try_divide(v * count, total), F.lit(0.0)) + 0.5)
    rows = (parties.withColumn("_low", F.least(F.greatest(at(F.col(seats) - n / 2 - 1) - 1, F.lit(0)), F.col(most)))
            .withColumn("_high", F.least(at(F.col(seats) + n / 2 + 1) + 1, F.col(most))))
    if not group:
        rows = stored(rows, "parties-bounds")
    rows = rows.withColumn("_open", F.col(seats) - over(rows, F.sum("_low")))
    keys = [*group, *party]
    ranked = (rows.where(F.col("_high") > F.col("_low"))
              .select(*keys, votes, "_open", F.explode(F.sequence("_low", F.col("_high") - 1)).alias("_k"))
              .withColumn("_q", v / (2 * F.col("_k") + 1)))
    order = [F.col("_q").desc(), *[F.col(p).asc_nulls_last() for p in party], F.col("_k").asc()]
    if group:
        ranked = ranked.withColumn("place", F.row_number().over(whole.orderBy(*order)) - 1)
    else:
        ranked = sums_before(ranked, order, {})
    won = ranked.where(F.col("place") < F.col("_open")).groupBy(*keys).agg(F.count("*").alias("_won"))
    return rows.join(won.withColumnsRenamed({k: f"_w_{k}" for k in keys}),
                     [rows[k].eqNullSafe(F.col(f"_w_{k}")) for k in keys], "left") \
        .withColumn(out, F.col("_low") + F.coalesce(F.col("_won"), F.lit(0))) \
        .drop("_low", "_high", "_open", "_won", *[f"_w_{k}" for k in keys])


def mixture(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: int = 3, share: float = 1.0,
            seed: int = 17, block: int = 8, shards: int = 8, bucket_docs: int = 20_000,
            doc_id: str = "doc_id", text: str = "text", source: str = "source",
            keep: Sequence[str] = ()) -> DataFrame:
    """Words that the mix takes of each document: doc_id, size, source_size, target, taken.

    Each source's documents stand in a seeded order, dealt over ``shards``, and each shard's words are
    cut into blocks of ``block`` words. Sainte-Laguë apportionment gives each source a whole number of
    blocks against its target, and each of its shards a quota by its own blocks. A shard takes its
    blocks round by round in that order from a seeded block on, each at most ``most`` times, so a
    document's part is a difference of positions and no block is a row. Sources are ranked in ranges, so there may be
    as many as there are hosts.

    Rows keep their number. NULL and empty texts have size 0 and give nothing; NULL sources are one
    source; rows with equal id and text stand side by side; an empty table gives an empty result; other
    columns are ignored. Positions are sums within ranges of ``bucket_docs`` documents plus sums over
    ranges, so a source with a third of all rows fills no task. Reruns agree. Columns named in ``keep``
    come along.
    """
    sized = stored(
        docs.select(docs[doc_id].alias("doc_id"), docs[source].alias("source"),
                    word_count(docs[text]).alias("size"),
                    F.xxhash64(F.lit(seed), docs[doc_id], docs[text]).alias("h"), *[docs[c] for c in keep])
        .withColumn("shard", F.pmod(F.xxhash64(F.col("h"), F.lit(seed)), F.lit(shards)).cast("int")),
        "mixture-sizes")
    supply = stored(sized.groupBy("source", "shard").agg(F.sum("size").alias("words"),
                                                        F.count("*").alias("docs")), "mixture-shards")
    targets = source_targets(supply.groupBy("source").agg(F.sum("words").alias("source_size")),
                             weights, most, share)
    blocks = F.ceil(F.col("words") / block).cast("long")
    shard_rows = supply.withColumn("blocks", blocks)
    per_source = shard_rows.groupBy(F.col("source").alias("b_source")).agg(
        F.sum("blocks").alias("source_blocks"))
    targets = targets.join(per_source, targets["source"].eqNullSafe(per_source["b_source"])).drop("b_source")
    targets = stored(targets, "mixture-targets")
    quotas = sainte_lague(
        targets.withColumn("seats", F.round(targets.agg(F.sum("target")).scalar() / block).cast("long"))
        .withColumn("limit", F.col("source_blocks") * most),
        [], "target", "seats", ["source"], "limit", "quota").select("source", "source_size", "target", "quota")
    quotas = stored(quotas, "mixture-quotas").withColumnRenamed("source", "q_source")
    plans = sainte_lague(
        shard_rows.join(quotas, shard_rows["source"].eqNullSafe(quotas["q_source"])).drop("q_source")
        .withColumn("limit", F.col("blocks") * most).withColumn("votes", F.col("blocks").cast("double")),
        ["source"], "votes", "quota", ["shard"], "limit", "shard_quota")
    ranges = F.ceil(F.col("docs") / bucket_docs)
    first = F.pmod(F.xxhash64(F.lit(seed), F.col("source"), F.col("shard")), F.greatest(F.col("blocks"), F.lit(1)))
    plans = stored(plans.select(
        F.col("source").alias("p_source"), F.col("shard").alias("p_shard"), "words", "blocks", "source_size",
        "target", ranges.alias("ranges"), first.alias("first"),
        F.when(F.col("blocks") > 0, F.floor(F.col("shard_quota") / F.col("blocks"))).otherwise(0)
        .cast("long").alias("rounds"),
        F.when(F.col("blocks") > 0, F.col("shard_quota") % F.col("blocks")).otherwise(0)
        .cast("long").alias("rest")), "mixture-plans")

    placed = sized.join(plans, sized["source"].eqNullSafe(plans["p_source"])
                        & (sized["shard"] == plans["p_shard"]))
    # The hash is the order, and its leading part the range.
    unit = F.col("h") / F.lit(2.0 ** 64) + 0.5
    placed = placed.withColumn("range", F.least(F.floor(unit * F.col("ranges")), F.col("ranges") - 1))
    sums = placed.groupBy("p_source", "p_shard", "range").agg(F.sum("size").alias("range_words"))
    before = (Window.partitionBy("p_source", "p_shard").orderBy("range")
              .rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(F.col("p_source").alias("s_source"), F.col("p_shard").alias("s_shard"),
                       F.col("range").alias("s_range"),
                       F.coalesce(F.sum("range_words").over(before), F.lit(0)).alias("base"))
    within = (Window.partitionBy("p_source", "p_shard", "range").orderBy("h", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.withColumn("at", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(sums, placed["p_source"].eqNullSafe(sums["s_source"])
                         & (placed["p_shard"] == sums["s_shard"]) & (placed["range"] == sums["s_range"]))
    start = F.col("base") + F.col("at")
    return placed.select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("rounds") + _overlap(start, start + F.col("size"), block)).cast("long")
        .alias("taken"), "source", *keep)


def _overlap(start: Column, end: Column, block: int) -> Column:
    """Words of [start, end) in the shard's ``rest`` blocks from block ``first`` on, going round."""
    words, from_block = F.col("words"), F.col("first")
    to_block = from_block + F.col("rest")
    zero = F.lit(0).cast("long")

    def part(a: Column, b: Column) -> Column:
        return F.greatest(F.least(end, F.least(b * block, words)) - F.greatest(start, F.least(a * block, words)), zero)

    return part(from_block, F.least(to_block, F.col("blocks"))) \
        + part(zero, F.greatest(to_block - F.col("blocks"), zero))
