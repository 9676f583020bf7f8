"""Mixing sources to target weights by a time-varying curriculum, with DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Weights of the sources in order of their code points, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
# Each source's weight at the start and at the end of training, over its mean; linear between.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
SHARE = 1.5
MOST_TIMES = 2.0
# A source's documents are dealt to slices by so many hexadecimal digits; a slice, not a source, is summed in one task.
SLICE_DIGITS = 3


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...], schedules: tuple[tuple[float, float], ...], share: float, most_times: float
) -> DataFrame:
    """One row for each source: its size, target, and schedule.

    The share of all sizes is divided by weight; a target stops at ``most_times`` the source's size and the excess goes
    to the others by weight. With the sources in order of limit over weight, the stopped ones are a prefix.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place"), F.lit(len(weights))) + 1).cast("int"))
    sources = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(order) - 1)
        .withColumn("weight", weight)
        .withColumn("most", F.lit(most_times) * F.col("source_size"))
        .withColumn("level", F.col("most") / F.col("weight"))
    )
    by_level = Window.orderBy("level", "place")
    above = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.lit(share) * F.sum("source_size").over(everything)
    water = (total - F.coalesce(F.sum("most").over(above), F.lit(0.0))) / F.sum("weight").over(rest)
    n = F.pmod(F.col("place"), F.lit(len(schedules)))
    pick = lambda at: F.element_at(F.array(*[F.lit(s[at]) for s in schedules]), (n + 1).cast("int"))
    return (
        sources.withColumn("water", water)
        # The first source that its level does not stop shows the level of all that follow.
        .withColumn("final", F.min(F.when(F.col("water") <= F.col("level"), F.struct("level", "place", "water"))).over(everything))
        .withColumn("target", F.coalesce(F.least(F.col("most"), F.col("weight") * F.col("final.water")), F.col("most")))
        .select("source", "place", "source_size", "target", pick(0).alias("from_weight"), pick(1).alias("to_weight"))
    )


def training_position(demand: Column, start: Column, end: Column) -> Column:
    """The time in [0, 1] at which a share ``demand`` of the source's tokens has been asked for.

    The integral of the weight start + (end - start) t, over its whole, is solved for t.
    """
    slope = end - start
    whole = (start + end) / 2
    root = F.sqrt(F.greatest(start * start + 2 * slope * whole * demand, F.lit(0.0)))
    return F.when(slope == 0, demand).otherwise(F.least((2 * whole * demand) / (start + root), F.lit(1.0)))


def turns(most_times: float) -> int:
    """How often the line of a source can be begun."""
    return int(-(-most_times // 1))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    schedules: tuple[tuple[float, float], ...] = SCHEDULES,
    share: float = SHARE,
    most_times: float = MOST_TIMES,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, size, source_size, target, taken, position and passes of every document, sorted by position.

    Each source's documents, in the order of a digest of their ids, fill a line of tokens that repeats; the mix takes
    the line up to the source's target, so a document's part of it is known from the tokens before it. ``position`` is
    the training time (0 to 1) at which the first pass reaches the document; ``passes`` has for each pass over the line the
    words that it takes of the document and the time at which it reaches it (1 if the target ends before).

    Null texts have size 0, null sources form the last source. Rows that repeat an id are ordered by size; equal rows get
    different parts of the line. An empty table gives no rows; other columns are left out, but for those in ``carry``, which
    also order rows that are otherwise equal.
    """
    sized = docs.select(
        *carry,
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("turn"),
    ).withColumn("slice", F.substring("turn", 1, SLICE_DIGITS))
    targets = source_targets(sized, weights, schedules, share, most_times)
    line = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
        .withColumn("slice_start", F.coalesce(F.sum("slice_size").over(line), F.lit(0)))
        .select(F.col("source").alias("s"), F.col("slice").alias("k"), "slice_start")
    )
    inside = Window.partitionBy("source", "slice").orderBy("turn", "doc_id", "size", *carry).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        sized.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(slices, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("k")))
        .withColumn("start", F.col("slice_start") + F.col("within"))
        .drop("s", "k")
        .join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    )
    # Whole words: the target is cut to a whole number of them.
    words = F.floor("target")
    parts = [F.greatest(F.lit(0), F.least(F.col("size"), words - turn * F.col("source_size") - F.col("start"))).cast("long") for turn in range(turns(most_times))]
    demand = lambda turn: F.when(F.col("target") > 0, F.least((turn * F.col("source_size") + F.col("start")) / F.col("target"), F.lit(1.0))).otherwise(F.lit(1.0))
    position = lambda turn: training_position(demand(turn), F.col("from_weight"), F.col("to_weight"))
    passes = F.array(*[F.struct(part.alias("part"), position(turn).alias("position")) for turn, part in enumerate(parts)])
    return (
        placed.select(*carry, "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), sum(parts, F.lit(0)).cast("long").alias("taken"), position(0).alias("position"), passes.alias("passes"))
        .orderBy("position", "doc_id")
    )
