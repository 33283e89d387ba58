"""Mixing sources to target weights that change in the course of training.

Each source has a schedule: its weight at times from 0 (start) to 1 (end), joined by straight lines. The
integral of its schedule is its share of the mix. A source's cumulative token demand at time t is its
target times the part of the integral up to t. Its documents come in an order fixed by a hash; a
document's place in the source's token stream, put into the inverse of the demand, is its training
position. Sorting by position gives the training order.

Everything is a DataFrame expression. Running sums over a source go over a fixed number of hash slices
first and inside each slice then, so no task holds a source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import saved

Schedule = Sequence[tuple[float, float]]

#: Slices a source is cut into by document hash. A task sorts one slice; their totals are slices x sources rows.
SLICES = 4096
#: A word is a run of these.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text: what is left of it when each word becomes one letter and white space nothing."""
    return F.coalesce(F.length(F.regexp_replace(F.regexp_replace(text, WORD, "x"), r"[\x20\x09-\x0D]+", "")), F.lit(0)).cast("long")


def _area(schedule: Schedule) -> float:
    return sum((b - a) * (x + y) / 2 for (a, x), (b, y) in zip(schedule, schedule[1:]))


def _check(schedule: Schedule) -> None:
    times = [t for t, _ in schedule]
    if len(schedule) < 2 or times[0] != 0 or times[-1] != 1 or any(a >= b for a, b in zip(times, times[1:])):
        raise ValueError("a schedule goes from time 0 to time 1, with times ascending")
    if any(w < 0 for _, w in schedule) or _area(schedule) <= 0:
        raise ValueError("a schedule has no negative weight, and some positive one")


def time_of(part: Column, schedule: Schedule) -> Column:
    """The time at which the given part (0 to 1) of the schedule's integral is reached."""
    whole, done, pieces = _area(schedule), 0.0, []
    for (a, x), (b, y) in zip(schedule, schedule[1:]):
        here = (b - a) * (x + y) / 2
        if here > 0:
            slope, need = (y - x) / (b - a), F.greatest(part * whole - done, F.lit(0.0))
            # Of x s + slope s^2 / 2 = need the root that stays stable where slope is 0.
            s = 2 * need / (F.lit(x) + F.sqrt(F.greatest(F.lit(x * x) + 2 * slope * need, F.lit(0.0))))
            pieces.append(((done + here) / whole, F.when(need <= 0, F.lit(float(a))).otherwise(F.least(a + s, F.lit(float(b))))))
        done += here
    out = pieces[-1][1]
    for upto, expression in reversed(pieces[:-1]):
        out = F.when(part <= upto, expression).otherwise(out)
    return out


def targets(totals: DataFrame, total_share: float = 1.0, max_repeats: int = 3) -> DataFrame:
    """totals (source, weight, source_size) with `target`: shares by weight of total_share x all sizes, none above
    max_repeats x its size; what is above goes to the others by weight, until none is above.

    A source is full if it would be at the level that fills all sources of a lower size per weight. With sources
    in the order of size per weight, the full ones are a first part of that order. If all are full, targets sum to less.
    """
    cap = F.lit(float(max_repeats)) * F.col("source_size")
    # One row a source: the sources' own table is the small one here, and the order is over it alone.
    filled = totals.withColumn("_cap", cap).withColumn("_level", F.col("_cap") / F.col("weight"))
    order = Window.orderBy("_level", F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    filled = filled.withColumn("_caps", F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    filled = filled.withColumn("_weights", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    filled = filled.withColumn("_all", F.sum("source_size").over(every) * F.lit(float(total_share)))
    filled = filled.withColumn("_at", (F.col("_all") - F.coalesce("_caps", F.lit(0.0))) / F.col("_weights"))
    filled = filled.withColumn("_full", F.col("_level") < F.col("_at"))
    # The level of those that aren't full is the one met by the first of them.
    filled = filled.withColumn("_stop", F.min(F.when(~F.col("_full"), F.struct("_level", "_at"))).over(every)["_at"])
    target = F.when(F.col("_full"), F.col("_cap")).otherwise(F.least("_cap", F.col("weight") * F.col("_stop")))
    return filled.withColumn("target", target).select(*totals.columns, "target")


def by_rank(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """sources (source, ...) with rank, by code point and null last, and with the weight of its rank, repeating."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    out = sources.withColumn("rank", rank)
    return out.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))


def mix(docs: DataFrame, schedules: Sequence[Schedule], max_repeats: int = 3, seed: int = 0, key: str = "doc_id", source: str = "source", text: str = "text", slices: int = SLICES, carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of docs: key, source, size (words), source_size, target, taken (words), repeats, and
    position, the time of its first take (null if it isn't taken), in the order of position.

    Sources by code point, null last, follow the schedules in turn. A source whose target is e times its size and a
    rest takes every document e times, and once more those the rest reaches at their middle or before. A document is
    taken whole or not at all. Times of later takes: `takes`. A document without words is never taken. Equal input
    gives equal output; rows that repeat are each a row of the mix, told apart by the columns to carry, which come last
    in the order of documents and in the output, or by nothing but their order.
    """
    for schedule in schedules:
        _check(schedule)
    weights = [_area(s) for s in schedules]
    rows = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), *carry)
    rows = rows.withColumn("hash", F.shiftrightunsigned(F.xxhash64(F.col("key"), F.lit(seed)), 1))
    # Slices are ranges of the hash, so how many there are changes nothing but who works on what.
    rows = rows.withColumn("slice", F.floor(F.shiftright("hash", 39) * slices / (1 << 24)).cast("int"))
    rows = saved(rows)
    parts = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    ahead = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("slice_size").over(ahead), F.lit(0)))
    totals = by_rank(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    totals = targets(totals, max_repeats=max_repeats)
    parts = parts.join(totals.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "slice_size")
    parts = parts.select(F.col("source").alias("_source"), F.col("slice").alias("_slice"), "before", "source_size", "target", "rank")
    inside = Window.partitionBy("source", "slice").orderBy("hash", "key", "size", *carry).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(parts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("slice") == F.col("_slice")))
    start, size, whole = F.col("before") + F.col("within"), F.col("size"), F.col("source_size")
    rounds = F.when(whole > 0, F.least(F.floor(F.col("target") / whole), F.lit(max_repeats))).otherwise(F.lit(0))
    rest = F.col("target") - rounds * whole
    once_more = ((2 * start + size) <= 2 * rest) & (rounds < max_repeats)
    repeats = F.when(size > 0, rounds + F.when(once_more, 1).otherwise(0)).otherwise(F.lit(0)).cast("int")
    part = F.least((2 * start + size) / (2 * F.col("target")), F.lit(1.0))
    position = F.lit(None).cast("double")
    for i, schedule in enumerate(schedules):
        position = F.when(F.pmod("rank", F.lit(len(schedules))) == i, time_of(part, schedule)).otherwise(position)
    out = rows.withColumn("repeats", repeats).withColumn("taken", (F.col("repeats") * size).cast("long"))
    out = out.withColumn("start", start).withColumn("position", F.when(F.col("repeats") > 0, position))
    return out.select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", "taken", "repeats", "position", "start", "rank", *carry).orderBy(
        F.col("position").asc_nulls_last(), F.col(key)
    )


def takes(mixed: DataFrame, schedules: Sequence[Schedule], key: str = "doc_id", carry: Sequence[str] = ()) -> DataFrame:
    """The training order: one row per take of a document (key, source, take from 0, position, what is carried), by position."""
    out = mixed.withColumn("take", F.explode(F.sequence(F.lit(0), F.greatest(F.col("repeats") - 1, F.lit(0))))).filter("repeats > 0")
    part = F.least((2 * (F.col("take") * F.col("source_size") + F.col("start")) + F.col("size")) / (2 * F.col("target")), F.lit(1.0))
    position = F.lit(None).cast("double")
    for i, schedule in enumerate(schedules):
        position = F.when(F.pmod("rank", F.lit(len(schedules))) == i, time_of(part, schedule)).otherwise(position)
    return out.select(key, "source", "take", position.alias("position"), *carry).orderBy("position", key, "take")

