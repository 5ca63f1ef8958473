"""Time-series operators per symbol.

A window over a whole symbol puts its history into one task. That is right for symbols of normal
size. The histories of hot symbols (more than ``rows_per_task`` rows) are cut by position instead: sampled bounds
over (symbol, time, ties) deal them to ranges, which are cut into chunks of half that many rows, wherever the times
crowd. A task works on many chunks. Each chunk borrows the few rows just before it (its halo), works, and gives back only its own rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tapeworks.operators.latest import matching, prefixed
from tapeworks.session import stored

ROWS_PER_TASK = 5_000_000
CHUNK, HALO = "_chunk", "_halo"

Compute = Callable[[WindowSpec], dict[str, Column]]


def hot_keys(df: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more rows than one task should get, and their number of rows ``_n``; stored.

    A count with a map-side part, run when called. At most rows / rows_per_task keys are hot.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > rows_per_task)
    return stored(counts, "hot-keys")


def chunks(rows: DataFrame, order: list[Column], n: int, size: int | None = None) -> DataFrame:
    """Rows with the number of their chunk: ``n`` ranges in ``order``, cut every ``size`` rows if given.

    A range is a task and a file, a chunk is neither, so small chunks cost no tasks. Stored, since bounds are sampled
    anew each time.
    """
    # The id counts the rows of a partition up from its number times 2^33.
    place = F.monotonically_increasing_id()
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(CHUNK, place)
    within = F.pmod(F.col(CHUNK), F.lit(2 ** 33))
    return stored(dealt.withColumn(CHUNK, F.col(CHUNK) - within + (0 if size is None else F.floor(within / size))), "chunks")


def ranges(rows: int, rows_per_task: int, tasks: int) -> int:
    """Tasks that deal ``rows`` to chunks: no more than chunks, no fewer than keep a task at a normal size."""
    return min(-(-2 * rows // rows_per_task), max(tasks, -(-2 * rows // ROWS_PER_TASK)))


def windowed(df: DataFrame, keys: list[str], time: str, ties: tuple[str, ...], rows_before: int,
             compute: Compute, reverse: bool = False,
             rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add window columns that look back ``rows_before`` rows (ahead, with ``reverse``).

    ``time`` and ``ties`` must order the rows of a key without ties; NULL times come before all
    others, and rows with a NULL key are one group. ``compute`` gets a window per key, in that order, and
    must not look farther.
    """
    if rows_before < 1:
        raise ValueError("rows_before must be at least 1")
    order = [F.col(time), *map(F.col, ties)]
    forth = [c.desc() if reverse else c.asc() for c in order]
    plain = compute(Window.partitionBy(*keys).orderBy(*forth))
    hot = hot_keys(df, keys, rows_per_task)
    rows = hot.agg(F.sum("_n")).first()[0]
    if rows is None:
        return df.withColumns(plain)
    known = prefixed(hot.select(*keys), keys)
    cold = df.join(known, matching(keys), "left_anti").withColumns(plain)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    data = chunks(df.join(known, matching(keys), "left_semi"), [*map(F.col, keys), *order],
                  ranges(rows, rows_per_task, tasks), max(1, rows_per_task // 2))
    added = compute(Window.partitionBy(*keys, CHUNK).orderBy(*forth))
    return cold.unionByName(
        data.withColumn(HALO, F.lit(False))
        .unionByName(_halo(data, keys, order, rows_before, reverse).withColumn(HALO, F.lit(True)))
        .withColumns(added)
        .where(~F.col(HALO)).select(*df.columns, *added))


def _halo(data: DataFrame, keys: list[str], order: list[Column], rows_before: int,
          reverse: bool) -> DataFrame:
    """Rows that a chunk borrows from the chunks before it, tagged with the borrowing chunk."""
    back = [c.asc() if reverse else c.desc() for c in order]
    # The last rows of each chunk: row_number <= n is applied before the shuffle.
    tail_window = Window.partitionBy(*keys, CHUNK).orderBy(*back)
    tails = (data.withColumn("_behind", F.row_number().over(tail_window))
             .where(F.col("_behind") <= rows_before))
    # Which later chunks need a tail row: those reached before rows_before rows have gone by.
    # One row per key and chunk; a short chunk may lend to several.
    sizes = data.groupBy(*keys, CHUNK).agg(F.count("*").alias("_size"))
    chunk_order = F.col(CHUNK).desc() if reverse else F.col(CHUNK).asc()
    by_chunk = Window.partitionBy(*keys).orderBy(chunk_order).rowsBetween(1, rows_before)
    following = sizes.withColumn("_next", F.collect_list(
        F.struct(F.col(CHUNK).alias("chunk"), F.col("_size").alias("size"))).over(by_chunk))
    between = F.aggregate(
        F.slice("_next", 1, F.col("_i")), F.lit(0).cast("bigint"), lambda total, c: total + c["size"])
    lent = (
        following.select(*keys, CHUNK, "_next", F.posexplode("_next").alias("_i", "_target"))
        .select(*keys, CHUNK, F.col("_target.chunk").alias("_to"), between.alias("_gap"))
        .where(F.col("_gap") < rows_before)
    )
    return (
        tails.join(prefixed(lent, [*keys, CHUNK]), matching([*keys, CHUNK]))
        .where(F.col("_behind") + F.col("_gap") <= rows_before)
        .withColumn(CHUNK, F.col("_to")).select(*data.columns)
    )


def rolling_avg(df: DataFrame, n: int, value: str = "close", time: str = "date",
                keys: tuple[str, ...] = ("symbol",), ties: tuple[str, ...] = (),
                rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Average of the last ``n`` rows per symbol, this one included."""
    if n < 2:
        return df.withColumn(f"rolling_avg_{n}", F.col(value).cast("double"))
    return windowed(
        df, list(keys), time, ties, n - 1,
        lambda w: {f"rolling_avg_{n}": F.avg(value).over(w.rowsBetween(1 - n, 0))},
        rows_per_task=rows_per_task)


def daily_return(df: DataFrame, value: str = "close", time: str = "date",
                 keys: tuple[str, ...] = ("symbol",), ties: tuple[str, ...] = (),
                 rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Change against the previous row of the symbol, as a fraction; NULL for the first row."""
    return windowed(
        df, list(keys), time, ties, 1,
        lambda w: {"daily_return": F.try_divide(F.col(value), F.lag(value).over(w)) - 1},
        rows_per_task=rows_per_task)


def scd2(df: DataFrame, key: str, updated_at: str, ties: tuple[str, ...] = (),
         rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Validity intervals of versions: from ``updated_at`` to that of the next version."""
    out = windowed(
        df, [key], updated_at, ties, 1, lambda w: {"valid_to": F.lag(updated_at).over(w)},
        reverse=True, rows_per_task=rows_per_task)
    return out.withColumns({
        "valid_from": F.col(updated_at), "is_current": F.col("valid_to").isNull()})


# Rows kept per symbol and interval.
HISTORY_LIMITS = {"1d": 30, "1h": 168, "1m": 1440}


def row_limits(df: DataFrame, limits: dict[str, int] | None = None, default: int = 30,
               interval: str = "interval", time: str = "date", ties: tuple[str, ...] = (),
               salts: int = 32) -> DataFrame:
    """Newest rows per symbol and interval, as many as the interval allows.

    Two steps: the newest within each of ``salts`` shares of a group, then the newest of those.
    The first step is the only shuffle of the whole input and spreads a hot group.
    """
    limits = HISTORY_LIMITS if limits is None else limits
    pairs = [F.lit(part) for pair in limits.items() for part in pair]
    limit = F.coalesce(F.create_map(*pairs)[F.col(interval)], F.lit(default)) if pairs else F.lit(default)
    newest = [F.col(c).desc() for c in (time, *ties)]
    most = max([default, *limits.values()])
    salt = F.pmod(F.xxhash64(time, *ties), F.lit(salts))

    def keep(rows: DataFrame, *groups: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("symbol", interval, *groups).orderBy(*newest))
        # The literal bound lets Spark cut groups before the shuffle; the map holds the exact one.
        return (rows.withColumn("_rank", rank).where(F.col("_rank") <= most)
                .where(F.col("_rank") <= limit).drop("_rank"))

    return keep(keep(df.withColumn("_salt", salt), "_salt").drop("_salt"))
