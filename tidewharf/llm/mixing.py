"""Mixing sources to target weights along a training curriculum.

Every source has a schedule of shares over the training run. Integrated, it gives the source's demand for
words up to any moment. Reading a source's documents one after the other, each begins at the moment when the
demand reaches the words before it: its training position. Sorted by position, the documents are the mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewharf.functions.scratch import materialized

WEIGHTS = (3, 1, 2)
BUDGET_PERCENT = 150
MAX_EPOCHS = 2
# The default curriculum: knots (moment, share) for each weight in turn. Sources of the first weight begin strong and
# give way to those of the third; those of the second stay even.
CURRICULUM = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))
RESULTS = ("size", "source_size", "target", "taken", "first_position", "last_position")


def word_count(text: Column) -> Column:
    """Words between white space; 0 for null."""
    plain = F.coalesce(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")), F.lit(""))
    return F.when(plain == "", F.lit(0)).otherwise(F.size(F.split(plain, r"[ \t\n\x0B\f\r]+"))).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, percent: int = BUDGET_PERCENT,
                   epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, weight, target)`` from ``(source, source_size)``, one row for each source.

    Sources in order of code points, null last, get the weights in turn, again from the first when they run
    out. They share ``percent`` of all sizes by weight. No target exceeds ``epochs`` times the source's size;
    what is above goes to the others by weight until nothing is above. Ordering by size over weight, the
    sources at their limit come first, so running sums find them. There is a row for each source, not for
    each document, in this one task.
    """
    everything = Window.partitionBy(F.lit(0))
    named = everything.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("turn", F.row_number().over(named) - 1)
    turn = F.col("turn") % len(weights) + 1
    rows = rows.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int")))
    filled = everything.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    limit = epochs * F.col("source_size")
    rest = F.sum("source_size").over(everything) * (percent / 100.0) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("rest", rest).withColumn("weight_left", weight_left)
    rows = rows.withColumn("full", F.col("rest") * F.col("weight") >= limit * F.col("weight_left"))
    # the first source that is not full fixes the level of all that follow
    open_ = F.when(~F.col("full"), F.struct(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source", "rest", "weight_left"))
    level = F.min(open_).over(everything)
    share = level["rest"] * F.col("weight") / level["weight_left"]
    target = F.when(F.col("full"), limit.cast("double")).otherwise(share)
    return rows.select("source", "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"), "turn")


Knots = Sequence[tuple[float, float]]


def integrated(knots: Knots) -> list[tuple[float, float, float]]:
    """``(at, share, done)``: the area under the share up to each knot."""
    out = [(*knots[0], 0.0)]
    for at, share in knots[1:]:
        before = out[-1]
        out.append((at, share, before[2] + (at - before[0]) * (share + before[1]) / 2))
    return out


def demand_curves(targets: DataFrame, schedule: DataFrame | Sequence[Knots] | None = None) -> DataFrame:
    """``targets`` with ``knots``: a source's demand in words as an array of ``(at, share, done)``.

    A schedule holds shares of the stream at moments from 0 to 1, linear between: as ``(source, at, share)`` rows, or as
    lists of ``(at, share)`` that the sources take in turn. ``done`` integrates the share up to a knot, scaled so that
    the whole run takes the target. Sources without a schedule are drawn evenly. A source has few knots; they lie in one row.
    """
    even = F.array(*[
        F.struct(F.lit(t).alias("at"), F.col("target").alias("share"), (F.col("target") * t).alias("done"))
        for t in (0.0, 1.0)
    ])
    if schedule is None:
        return targets.withColumn("knots", even)
    names = ("at", "share", "done")
    if isinstance(schedule, DataFrame):
        by_source = Window.partitionBy("source").orderBy("at")
        step = (F.col("at") - F.lag("at").over(by_source)) * (F.col("share") + F.lag("share").over(by_source)) / 2
        done = F.sum(F.coalesce(step, F.lit(0.0))).over(by_source)
        curves = schedule.withColumn("done", done).groupBy(F.col("source").alias("named")).agg(
            F.sort_array(F.collect_list(F.struct(*names))).alias("knots")
        )
        joined = targets.join(curves, F.col("source").eqNullSafe(F.col("named")), "left").drop("named")
    else:
        lists = [F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(names, knot)]) for knot in integrated(own)]) for own in schedule]
        turn = (F.col("turn") % len(lists) + 1).cast("int")
        joined = targets.withColumn("knots", F.element_at(F.array(*lists), turn))
    whole = F.element_at("knots", -1)["done"]
    factor = F.col("target") / whole
    scaled = F.transform("knots", lambda k: F.struct(
        k["at"].alias("at"), (k["share"] * factor).alias("share"), (k["done"] * factor).alias("done")
    ))
    return joined.withColumn("knots", F.when(whole > 0, scaled).otherwise(even))


def position(knots: Column, words: Column) -> Column:
    """The moment at which the demand in ``knots`` reaches ``words``: in its segment, the root of a parabola."""
    late = F.filter(knots, lambda k: k["done"] <= words)
    n = F.least(F.greatest(F.size(late), F.lit(1)), F.size(knots) - 1)
    a, b = F.element_at(knots, n), F.element_at(knots, n + 1)
    width, need = b["at"] - a["at"], F.greatest(words - a["done"], F.lit(0.0))
    bend = F.when(width > 0, (b["share"] - a["share"]) / width).otherwise(0.0)
    root = F.sqrt(F.greatest(a["share"] * a["share"] + 2 * bend * need, F.lit(0.0)))
    moved = F.when(a["share"] + root > 0, 2 * need / (a["share"] + root)).otherwise(0.0)
    return F.least(a["at"] + F.least(moved, width), F.lit(1.0))


def assigned(docs: DataFrame, weights: Sequence[float] = WEIGHTS, percent: int = BUDGET_PERCENT,
             epochs: int = MAX_EPOCHS, schedule: DataFrame | Sequence[Knots] | None = None) -> DataFrame:
    """The rows of ``docs`` with ``size``, ``source_size``, ``target``, ``taken``, ``first_position``, ``last_position``.

    A source's documents are read in the order of a hash, again from the start up to ``epochs`` times, until
    the target is reached; the last one is cut there. ``taken`` are the words read of a document, repeats
    counted; positions are null for documents that are not read. Needs ``doc_id``, ``text`` and ``source``;
    other columns stay as they are, but for those with the names of results, which are replaced. Null texts have no words and are never read. Equal rows are told apart
    only by their order, which does not matter as they are equal. Reruns agree. Without a ``schedule`` sources are drawn evenly;
    ``CURRICULUM`` is the one of the registered query and the pipeline.

    A source's running sum is taken in two steps, inside slices and over slices, both of about the square
    root of the number of documents; so no task holds a whole source.
    """
    kept = [c for c in docs.columns if c.lower() not in RESULTS]
    docs = docs.select(*kept)
    tag = "_mix"
    while any(c.lower().startswith(tag) for c in kept):
        tag += "_"
    named = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias(tag + "_source")  # never null, for joins
    turn = F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary"))).cast("binary"))
    size = materialized(docs.select(named, turn.alias(tag + "_turn"), word_count(F.col("text")).alias(tag + "_size")))
    slices = max(int(size.count() ** 0.5), 1)
    leading = F.conv(F.substring(tag + "_turn", 1, 8), 16, 10).cast("long")
    piece = F.floor(leading * slices / 4294967296).cast("long").alias(tag + "_slice")

    per_slice = size.groupBy(tag + "_source", piece).agg(F.sum(tag + "_size").alias("words"))
    earlier = Window.partitionBy(tag + "_source").orderBy(tag + "_slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = materialized(per_slice.withColumn(tag + "_before", F.coalesce(F.sum("words").over(earlier), F.lit(0))))
    sources = per_slice.groupBy(tag + "_source").agg(F.sum("words").alias("source_size")).select(
        F.when(F.col(tag + "_source") != "", F.expr(f"substring({tag}_source, 2)")).alias("source"), "source_size"
    )
    curves = demand_curves(source_targets(sources, weights, percent, epochs), schedule)
    curves = materialized(curves.select(named, "source_size", "target", F.col("knots").alias(tag + "_knots")))
    inside = Window.partitionBy(tag + "_source", tag + "_slice").orderBy(tag + "_turn").rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        docs.withColumn(tag + "_source", named).withColumn(tag + "_turn", turn).withColumn(tag + "_slice", piece)
        .withColumn(tag + "_size", word_count(F.col("text")))
        .withColumn(tag + "_inner", F.coalesce(F.sum(tag + "_size").over(inside), F.lit(0)))
        .join(per_slice.select(tag + "_source", tag + "_slice", tag + "_before").join(curves, tag + "_source"), [tag + "_source", tag + "_slice"])
    )
    start, whole = F.col(tag + "_before") + F.col(tag + "_inner"), F.round("target").cast("long")
    parts = [
        F.greatest(F.least(F.col(tag + "_size"), whole - start - epoch * F.col("source_size")), F.lit(0)) for epoch in range(epochs)
    ]
    reads = sum((F.when(p > 0, 1).otherwise(0) for p in parts[1:]), F.when(parts[0] > 0, 1).otherwise(0))
    taken = sum(parts[1:], parts[0])
    knots = F.col(tag + "_knots")
    last = start + (reads - 1) * F.col("source_size")
    return rows.withColumn("taken", taken).select(
        *kept, F.col(tag + "_size").alias("size"), "source_size", "target", "taken",
        F.when(F.col("taken") > 0, position(knots, start.cast("double"))).alias("first_position"),
        F.when(F.col("taken") > 0, position(knots, last.cast("double"))).alias("last_position"),
    )


def training_order(rows: DataFrame) -> DataFrame:
    """The documents that are read, ordered by position over all partitions; a tie goes to the smaller key."""
    return by_position(rows.where("taken > 0"))


def by_position(rows: DataFrame) -> DataFrame:
    """Ranges of positions, sorted; documents that are not read come last."""
    return rows.orderBy(F.col("first_position").asc_nulls_last(), "doc_id")
