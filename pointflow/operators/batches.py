"""The batch twins of the stream operators: items that carry the number of the batch they came in."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

# batch numbers are added up in blocks of 2^22, and blocks in blocks; three levels hold all 64-bit numbers
BLOCK_BITS = 22
LEVELS = 3
# microseconds before 1970 that no timestamp reaches
FIRST_MICROS = 10**17
# blocks of batches that one step of the search for the last taken batch counts
INDEX_BLOCKS = 4096
# local and universal time differ by less than this
ZONE_SLACK = timedelta(days=1)


def batch_number(ts: str | Column, seconds: int) -> Column:
    """The index since 1970 of the interval of that many seconds that a timestamp lies in."""
    at = F.col(ts) if isinstance(ts, str) else ts
    if seconds < 1:
        raise ValueError("seconds must be positive")
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", start, at.cast("timestamp_ntz"))
    width = seconds * 1_000_000
    # `div` cuts towards zero, so count from a number below the first year and take it off again
    ahead = FIRST_MICROS // width + 1
    return F.call_function("div", micros + ahead * width, F.lit(width)) - ahead


def batch_sizes(items: DataFrame, batch: str = "batch") -> DataFrame:
    """`(batch, n)`; batches without items have no row, items without a batch are left out."""
    return items.where(F.col(batch).isNotNull()).groupBy(batch).agg(F.count(F.lit(1)).alias("n"))


def running_before(sizes: DataFrame, batch: str = "batch") -> DataFrame:
    """Adds `n_before`, the sum of `n` over all smaller batch numbers; rows without a number are left out.

    A window over all batches would sort them in one task. Here they are summed
    within blocks of numbers, the totals of blocks within larger blocks, and
    only the largest blocks, at most 2^20 of them, in one task, however far
    apart the numbers are.
    """
    known = sizes.where(F.col(batch).isNotNull())
    at = known.select("*", F.col(batch).cast("bigint").alias("__at"))
    return _before(at, LEVELS).select(*sizes.columns, "n_before")


def _before(rows: DataFrame, levels: int) -> DataFrame:
    """Adds the sum of `n` over all smaller values of `__at`, which is unique and not NULL."""
    upto = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    if levels == 1:
        return rows.selectExpr("*", f"coalesce(sum(n) OVER (ORDER BY __at {upto}), 0L) AS n_before")
    # never NULL, so the join adds no filter and both sides reuse one shuffle of the sizes
    block = F.coalesce(F.shiftright("__at", BLOCK_BITS), F.lit(0)).alias("__block")
    own = rows.select("*", block)
    inside = own.selectExpr("*", f"sum(n) OVER (PARTITION BY __block ORDER BY __at {upto}) AS __inside")
    totals = own.groupBy("__block").agg(F.sum("n").alias("n")).withColumnRenamed("__block", "__at")
    earlier = _before(totals, levels - 1).selectExpr("__at AS __block", "n_before AS __earlier")
    n_before = F.coalesce("__inside", F.lit(0)) + F.coalesce("__earlier", F.lit(0))
    return inside.join(earlier, "__block").select(*rows.columns, n_before.alias("n_before"))


def taken_until(items: DataFrame, threshold: int, batch: str = "batch") -> DataFrame:
    """The items of the batches that a stream with this threshold would process.

    A batch is taken whole if fewer than `threshold` items came before it. The
    taken batches are the first ones, so one number says which they are.
    """
    if threshold < 1:
        raise ValueError("threshold must be positive")
    sizes = running_before(batch_sizes(items, batch), batch)
    # not a filter, which would be pushed below one side of the join only
    last = sizes.agg(F.max(F.when(F.col("n_before") < threshold, F.col(batch))))
    return items.where(F.col(batch) <= last.scalar())


def time_bounds(events: DataFrame, ts: str, seconds: int, low: int | None, high: int | None) -> Column:
    """What the raw time column of the batches low to high fulfils at least, in a form that a scan can prune by.

    A column of universal time is bounded with a day to spare, as batches are
    numbered by local time; the batch number itself decides. Other types and
    years that have no literal are not bounded.
    """
    kind = events.schema[ts].dataType
    held = F.col(ts).isNotNull()
    if not isinstance(kind, (TimestampNTZType, TimestampType)):
        return held
    slack = ZONE_SLACK if isinstance(kind, TimestampType) else timedelta()
    for number, sign in ((low, -1), (None if high is None else high + 1, 1)):
        try:
            edge = number is not None and datetime(1970, 1, 1) + timedelta(seconds=number * seconds) + sign * slack
        except OverflowError:
            edge = False
        if edge:
            bound = F.lit(edge.isoformat(sep=" ")).cast(kind)
            held &= F.col(ts) >= bound if sign < 0 else F.col(ts) < bound
    return held


def last_taken(events: DataFrame, threshold: int, ts: str, seconds: int) -> int | None:
    """The last batch that a stream with this threshold processes; None if no event has a time.

    An index of at most INDEX_BLOCKS counts over ranges of batches tells the range
    in which the threshold is crossed, and is then made for that range alone,
    which prunes its scan by the raw time. Three steps at most reach a single
    batch, and one does where there are no more batches than blocks.
    """
    if threshold < 1:
        raise ValueError("threshold must be positive")
    number = batch_number(ts, seconds)
    low, high = events.where(F.col(ts).isNotNull()).agg(F.min(number), F.max(number)).first()
    if low is None:
        return None
    before = 0
    while True:
        width = -(-(high - low + 1) // INDEX_BLOCKS)
        inside = time_bounds(events, ts, seconds, low, high) & number.between(low, high)
        block = F.call_function("div", number - low, F.lit(width).cast("bigint")).alias("block")
        counts = events.where(inside).groupBy(block).agg(F.count(F.lit(1)).alias("n")).collect()
        for found, n in sorted(counts):
            if before + n >= threshold:
                low, high = low + found * width, min(high, low + (found + 1) * width - 1)
                break
            before += n
        else:
            return high
        if width == 1:
            return low


def taken_events(events: DataFrame, threshold: int, ts: str, seconds: int) -> DataFrame:
    """The rows that a stream of batches of so many seconds would process before it stops.

    The same as `taken_until` for batches that are intervals of a time column: the
    last taken batch is found first, so the scan of the rows themselves is pruned
    by a bound on the raw column. Events without a time are left out.
    """
    last = last_taken(events, threshold, ts, seconds)
    if last is None:
        return events.where(F.lit(False))
    return events.where(time_bounds(events, ts, seconds, None, last) & (batch_number(ts, seconds) <= last))


def batch_distinct(items: DataFrame, batch: str = "batch", item: str = "item") -> DataFrame:
    return items.select(batch, item).distinct()


def distinct_union(*parts: DataFrame, item: str = "item") -> DataFrame:
    """The set of the items of all parts; each task drops its duplicates before the shuffle."""
    if not parts:
        raise ValueError("give at least one part")
    return reduce(DataFrame.union, [p.select(item) for p in parts]).distinct()


def item_counts(items: DataFrame, item: str = "item") -> DataFrame:
    return items.groupBy(item).agg(F.count(F.lit(1)).alias("cnt"))


def item_summary(items: DataFrame, item: str = "item") -> DataFrame:
    """One row `processed, n_distinct, largest`; `largest` is NULL without items."""
    return summary_of_counts(item_counts(items, item), item)


def summary_of_counts(counts: DataFrame, item: str = "item") -> DataFrame:
    return counts.agg(
        F.coalesce(F.sum("cnt"), F.lit(0)).alias("processed"),
        F.count(item).alias("n_distinct"),
        F.max(item).alias("largest"),
    )


def largest_item(items: DataFrame, item: str = "item") -> DataFrame:
    """The row of the largest item; a top-1, so no task ever holds more than its own best."""
    return items.select(item).orderBy(F.desc(item)).limit(1)
