"""Mixing sources to target weights along a curriculum, with DataFrame operations only.

Each source has a weight that varies over training time 0..1, piecewise linear. Its integral is the source's share of
the words; the cumulative integral is its demand, and inverting it gives the time at which the source's n-th word is
read. Documents are range-sorted by that time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize

#: Documents of a source are dealt into so many slices for running sums: one slice holds about this many rows.
SLICE_ROWS = 2_000


def sizes(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """docs' doc_id, source and size, the number of words (null text: 0), and the columns in keep."""
    n = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(*dict.fromkeys(["doc_id", "source", *(keep or [])]), n.alias("size"))


def contract_weights(sources: DataFrame) -> DataFrame:
    """sources (source, source_size) with weight 1, 2, 3, repeating by code points, null last, and its schedule.

    The weight is the schedule's integral; a source of odd place is read more at the end, one of even place at the start.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = (place % 3 + 1).cast("double")
    tilt = F.when(place % 2 == 1, 0.5).otherwise(-0.5)
    knot = lambda t, w: F.struct(F.lit(float(t)).alias("t"), w.alias("w"))
    knots = F.array(knot(0, weight * (1 - tilt)), knot(1, weight * (1 + tilt)))
    return sources.select("source", "source_size", knots.alias("knots"))


def integral(knots: Column) -> Column:
    """The area under the piecewise linear schedule array<struct<t, w>>, sorted by t."""
    pairs = F.sequence(F.lit(1), F.size(knots) - 1)
    area = F.transform(pairs, lambda i: (knots[i].t - knots[i - 1].t) * (knots[i].w + knots[i - 1].w) / 2)
    return F.aggregate(area, F.lit(0.0), lambda a, x: a + x)


def invert(knots: Column, demand: Column) -> Column:
    """The time at which the area under the schedule reaches demand; the last knot's time beyond the whole area."""
    last = knots[F.size(knots) - 1].t

    def step(state: Column, i: Column) -> Column:
        dt, w0, w1 = knots[i].t - knots[i - 1].t, knots[i - 1].w, knots[i].w
        area = dt * (w0 + w1) / 2
        left = state.left
        slope = (w1 - w0) / dt
        root = F.sqrt(F.greatest(w0 * w0 + 2 * slope * left, F.lit(0.0)))
        at = knots[i - 1].t + F.coalesce(F.try_divide(2 * left, w0 + root), F.lit(0.0))
        here = state.at.isNull() & (left <= area) & (area > 0)
        return F.struct(F.when(here, F.least(at, knots[i].t)).otherwise(state.at).alias("at"), (left - area).alias("left"))

    start = F.struct(F.lit(None).cast("double").alias("at"), demand.cast("double").alias("left"))
    found = F.aggregate(F.sequence(F.lit(1), F.size(knots) - 1), start, step, lambda s: s.at)
    return F.coalesce(found, last)


def targets(sources: DataFrame, most: float = 3.0) -> DataFrame:
    """sources (source, source_size, knots) with target: 100% of all sizes shared by weight, none above most times its size.

    Sharing the excess again until none is above ends at one water level: target = least(most * size, level * weight).
    Sorted by the level at which each source is full, the level is found from running sums, without iteration. The table
    has a row for each source, so its windows may run in one task.
    """
    s = sources.withColumn("weight", integral(F.col("knots"))).withColumn("cap", F.col("source_size") * F.lit(most))
    s = s.withColumn("full", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(float("inf"))))
    everything = Window.partitionBy(F.lit(0))
    below = everything.orderBy("full", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("total", F.sum("source_size").over(everything).cast("double"))
    s = s.withColumn("filled", F.coalesce(F.sum("cap").over(below), F.lit(0.0)))
    s = s.withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0.0)))
    s = s.withColumn("try", F.when(F.col("open") > 0, (F.col("total") - F.col("filled")) / F.col("open")))
    # the first source in this order that its share does not fill sets the level; later ones would give less
    level = F.max(F.when(F.col("try") <= F.col("full"), F.col("try"))).over(everything)
    target = F.when(F.col("weight") > 0, F.least("cap", F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))).otherwise(F.lit(0.0))
    return s.select("source", "source_size", "knots", "weight", target.alias("target"))


def placed(docs: DataFrame, weights=contract_weights, most: float = 3.0, seed: int = 17, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken, position, positions) for each row of docs, and the columns in keep.

    weights maps (source, source_size) to (source, source_size, knots). In the source's shuffled order, fixed by seed and
    doc_id, every document is taken floor(target / source_size) times, and once more while the words so taken stay
    within the rest; the one that crosses the line is taken if more than half of it is inside. So a source misses its
    target by at most half a document. positions are the training times at which the copies are read: the source's words
    are taken in passes, target of them in all, and the demand for them is inverted where a copy starts; a document that
    is not taken has none. position is the first of them, or null. Running sums are by slice: counts by slice first, then
    rows within one, so that a source with a third of all rows is spread over many tasks. Empty tables give an empty
    result; null text has size 0; a null source is a source; rows that share an id are documents of their own; of
    columns that clash with the result's the result's stays.
    """
    sized = materialize(sizes(docs, keep), "sizes")
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    plan = targets(weights(per.select("source", "source_size")), most)
    per = per.select(F.col("source").alias("s"), F.ceil(F.col("rows") / SLICE_ROWS).alias("slices"))
    plan = materialize(plan.join(per, F.col("source").eqNullSafe(F.col("s"))).drop("s"), "plan")
    # 60 bits of a hash that other engines have as well
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    order = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    known = sized.alias("d").join(plan.alias("p"), F.expr("d.source <=> p.source")).select("d.*", "p.source_size", "p.target", "p.weight", "p.knots", "p.slices", order.alias("_order"))
    known = known.withColumn("_slice", F.floor(F.col("_order") / F.lit(2.0**60) * F.col("slices")))
    by_slice = known.groupBy("source", "_slice").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    by_slice = by_slice.select(F.col("source").alias("s"), F.col("_slice").alias("sl"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "_slice").orderBy("_order", "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ran = known.withColumn("_upto", F.sum("size").over(inside))
    ran = ran.join(by_slice, F.col("source").eqNullSafe(F.col("s")) & (F.col("_slice") == F.col("sl")))
    start = F.col("base") + F.col("_upto") - F.col("size")
    whole = F.floor(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)))
    rest = F.col("target") - whole * F.col("source_size")
    once_more = (start + F.col("size") / 2 < rest).cast("long")
    copies = F.least(whole + once_more, F.lit(int(most))).cast("long")
    passes = F.when(copies > 0, F.sequence(F.lit(0), (copies - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    due = lambda c: F.coalesce(F.try_divide((c * F.col("source_size") + start) * F.col("weight"), F.col("target")), F.lit(0.0))
    positions = F.transform(passes, lambda c: invert(F.col("knots"), due(c)))
    out = ran.select("doc_id", "source", *[c for c in keep or [] if c not in ("doc_id", "source")], "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), positions.alias("positions"))
    return out.withColumn("position", F.get("positions", F.lit(0)))


def mix(docs: DataFrame, weights=contract_weights, most: float = 3.0, seed: int = 17, keep: list[str] | None = None) -> DataFrame:
    """placed(), range-sorted by position; ids split the ranges of equal positions and of documents that are not taken."""
    out = placed(docs, weights, most, seed, keep)
    return out.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def resample(docs: DataFrame, weights=contract_weights, most: float = 3.0, seed: int = 17) -> DataFrame:
    """The rows of docs, each as often as the mixture takes it, range-sorted by the copies' positions; columns are unchanged.

    Only ids, sizes and positions go through the mixture; texts are joined to the result. Rows that share id and text
    are taken as often as one of them. Documents without words belong to no source's demand and stay once.
    """
    word_hash = F.xxhash64("text")
    keys = docs.select("doc_id", "source", "text", word_hash.alias("_text"))
    mixed = placed(keys, weights, most, seed, keep=["_text"])
    # without words: once, at the beginning
    at = F.when(F.col("size") > 0, F.col("positions")).otherwise(F.array(F.coalesce("position", F.lit(0.0))))
    mixed = mixed.select("doc_id", "_text", at.alias("at")).groupBy("doc_id", "_text").agg(F.min(F.struct(F.size("at").alias("n"), "at")).alias("m"))
    mixed = mixed.where("m.n > 0").select(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash"), F.col("m.at").alias("_positions"))
    mixed = materialize(mixed, "mixed")
    out = docs.withColumn("_text", word_hash).join(mixed, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")))
    out = out.withColumn("_position", F.explode("_positions"))
    return out.repartitionByRange("_position", "doc_id").sortWithinPartitions("_position", "doc_id").select(*docs.columns)
