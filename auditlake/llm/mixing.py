"""Mixing of sources by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlake.llm.common import slices, stage

# Of each factor e of a source's keys; only the rows of the bin in which its budget ends are sorted.
BINS = 1 << 10
# A document's words count at most so often, and so do a source's.
MOST = 3
WEIGHTS = (5, 2, 1)
#: Weights below this would make keys that are never drawn.
LEAST_QUALITY = 0.05


def measured(docs: DataFrame, text: str, *keep: Column) -> DataFrame:
    """``keep``, ``size`` (words) and ``quality`` (its share of different words, 0.05 at least)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [t.encode().split() if t else [] for t in batch.column(0).to_pylist()]
            size = pa.array([len(w) for w in words], pa.int64())
            quality = pa.array(
                [max(LEAST_QUALITY, len(set(w)) / len(w)) if w else LEAST_QUALITY for w in words], pa.float64()
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], size, quality], names=[*batch.schema.names[1:], "size", "quality"]
            )

    rows = docs.select(F.col(text).alias("__text"), *keep)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(measure, f"{kept}, size long, quality double")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code-point order, null last, have the weights in turn and share the sum of all sizes
    by them. A target stops at ``most`` times its source's size; what is above is shared again
    by weight until none is above. That is one level L with target = min(L * weight, bound), and
    the bounds sorted by bound / weight show which of them L passes. One row for each source
    meets in one task here, never one for each document.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    rows = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, map(float, weights))), (place + 1).cast("int")))
    rows = rows.withColumn("bound", F.lit(float(most)) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("bound") / F.col("w"), F.col("source").asc_nulls_last())
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rows = (
        rows.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("bounds_before", F.coalesce(F.sum("bound").over(before), F.lit(0.0)))
        .withColumn("weights_from", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("bounds_before")) / F.col("weights_from"))
    )
    # The level that holds is that of the first source whose bound is not passed.
    ratio = F.col("bound") / F.col("w")
    fits = F.when(F.col("level") * F.col("w") <= F.col("bound"), F.struct(ratio.alias("ratio"), "level"))
    return rows.withColumn("holds", F.min(fits).over(everything)["level"]).select(
        "source",
        "source_size",
        F.coalesce(F.least(F.col("holds") * F.col("w"), F.col("bound")), F.col("bound")).alias("target"),
    )


def draw_key(ident: Column, quality: Column, seed: str) -> Column:
    """Exponential variate over the weight: the same for an id on each run, small ones first."""
    u = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(ident.cast("string"), F.lit("")))), 1, 13), 16, 10)
    return -F.log((u.cast("double") + 0.5) / float(1 << 52)) / quality


def key_bin(key: Column) -> Column:
    """Bins of equal width in the key's logarithm: that of an exponential variate has a density of 1 / e at
    most, whatever its weight, so a bin is expected to hold no more than 1 / (e * BINS) of a source's rows."""
    return F.floor(F.log(key) * BINS).cast("int")


def mix(
    docs: DataFrame,
    ident: str,
    source: str,
    text: str,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST,
    seed: str = "mix",
    draw: str | None = None,
) -> DataFrame:
    """(<ident>, source, size, source_size, target, times, taken) for each row of ``docs``.

    A source whose target holds its size e times takes each of its documents e times (complete
    epochs). What is left of the target goes to its documents in order of their keys, whole, as
    long as the sum of sizes stays within; the next document is taken too if that brings the sum
    nearer to the target. ``times`` is how often a document is taken and ``taken`` its words so
    taken. No document is taken more than ``most`` times. Keys are drawn from the column ``draw``, the
    id if it is not named.

    Sizes are words; null texts have none. Null sources are one source, the last. Equal keys of
    repeated rows are ordered by size, then in any order. A source without words has target 0.
    An empty table gives no rows.

    Sizes are summed in bins of the keys, so that of a source only the rows of one bin, about one row in
    2700 at most, are sorted, whatever the source's share of all rows and its qualities. Rows of one
    id have one key for each quality and share a bin.
    """
    names = F.col(ident).alias("ident"), F.col(source).alias("source"), F.col(draw or ident).alias("draw")
    rows = measured(docs, text, *names)
    rows = stage(rows.withColumn("key", draw_key(F.col("draw"), F.col("quality"), seed)).drop("draw"), "mix-sizes")
    return decided(rows, weights, most).select(
        F.col("ident").alias(ident),
        "source",
        "size",
        "source_size",
        "target",
        (F.col("epochs") + F.col("part")).cast("int").alias("times"),
        ((F.col("epochs") + F.col("part")) * F.col("size")).alias("taken"),
    )


def take(
    docs: DataFrame,
    source: str,
    text: str,
    draw: str,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST,
    seed: str = "mix",
) -> DataFrame:
    """The rows of ``docs``, all their columns, each as often as ``mix`` takes it: not at all, or up to ``most`` times.

    Sizes and keys are written beside the rows, and the plan of a source says of most rows by their key alone
    how often they are taken. So texts stay where they are; only the rows of the bins in which budgets
    end, about one in 2700, are shuffled. Nulls, ties, repeated rows and an empty table are as in ``mix``.
    """
    own = {c: f"__d{i}" for i, c in enumerate(docs.columns)}
    wide = measured(
        docs, text, *[F.col(c).alias(new) for c, new in own.items()], F.col(source).alias("source"),
        F.monotonically_increasing_id().alias("ident"),
    )
    wide = stage(wide.withColumn("key", draw_key(F.col(own[draw]), F.col("quality"), seed)), "mix-rows")
    rows = decided(wide, weights, most).withColumn("times", (F.col("epochs") + F.col("part")).cast("int"))
    taken = rows.where("times > 0").withColumn("__time", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return taken.select(*[F.col(new).alias(c) for c, new in own.items()])


def decided(rows: DataFrame, weights: Sequence[float], most: int) -> DataFrame:
    """``rows`` (ident, source, size, key, others) with their source's plan, ``epochs`` and ``part`` (0 or 1 more)."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = (
        targets(sizes, weights, most)
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    rows = rows.withColumn("bin", key_bin(F.col("key")))
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (
        rows.groupBy("source", "bin").agg(F.sum("size").alias("n"))
        .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    )
    edge = bins.join(plan, bins["source"].eqNullSafe(plan["source"])).where("start <= budget and start + n > budget")
    plan = stage(
        plan.join(
            edge.select(bins["source"].alias("s"), "bin", "start"), plan["source"].eqNullSafe(F.col("s")), "left"
        ).select(plan["source"].alias("s"), "source_size", "target", "epochs", "budget", F.col("bin").alias("last"), "start"),
        "mix-plan",
    )
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    inside = Window.partitionBy("source").orderBy("key", "ident", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = rows.where("bin = last").withColumn("sum", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # A document that crosses the budget is taken if more than half of it lies within.
    part = F.when(2 * (F.col("budget") - F.col("sum")) >= F.col("size"), 1).otherwise(0)
    edge = edge.withColumn("part", F.when(F.col("epochs") < most, part).otherwise(0)).drop("sum")
    rest = rows.where("last is null or bin <> last").withColumn(
        "part", F.when((F.col("epochs") < most) & (F.col("bin") < F.col("last")), 1).otherwise(0)
    )
    return rest.unionByName(edge)
