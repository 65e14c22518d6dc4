"""Mixing sources to target weights by entropy balancing, with DataFrame functions only.

Every document gets a rate ``min(cap, exp(lam * x))``, where ``x`` is its size over the
mean size of its source: the exponential tilt that stays closest to taking each document
once while the taken words of its source meet the target. ``lam`` is the solution of the
convex dual problem of the source; all are found together by safeguarded Newton steps,
each one map-side-combined aggregation. The documents enter as (source, size) classes
with counts, so no step after the first reads them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import WORD, Scratch, settle, spare

#: Rows of a class are dealt over slices of about so many, so that no window holds more.
SLICE = 4096
#: Newton steps at most, and the relative gap between words and target that ends them.
STEPS = 60
CLOSE = 1e-6
#: Rounds in which single classes gain or lose copies after rounding.
REPAIRS = 4


def word_count(text: Column) -> Column:
    """Number of words; NULL text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """Per source (source, source_size): weight and target.

    Sources in code-point order, NULL last, weigh ``weights`` in turn and share the total
    of all sizes. A target stops at ``cap`` times its source's size; the excess is shared
    anew by weight among the others until none is above. That end state is found in
    closed form: sources are capped in ascending order of cap per weight, so prefix sums
    tell how many are.
    """
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    # The windows order one row per source.
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    with_weight = sizes.withColumn(
        "weight", F.element_at(pattern, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    )
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    ranked = with_weight.withColumn("level", level).withColumn(
        "capped", F.col("level") * F.col("weight") > cap * F.col("source_size")
    )
    # The first source that is not capped sets the level of all after it.
    free_level = F.min(F.when(~F.col("capped"), F.struct(F.col("source_size") / F.col("weight"), "level"))).over(everything)["level"]
    return ranked.select(
        "source",
        "source_size",
        "weight",
        F.coalesce(F.least(cap * F.col("source_size"), free_level * F.col("weight")), cap * F.col("source_size"))
        .cast("double")
        .alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    cap: int = 3,
    doc: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Per document: doc_id, size, source_size, target, rate and copies (0 to ``cap``).

    Copies come from the rates by systematic rounding over the size classes of a source,
    then single classes gain or lose copies until the words taken are as near the target
    as sizes allow; within a class copies go by a hash of the id, so reruns agree. NULL
    or empty texts have size 0 and are taken never; an empty table gives no rows; repeated
    rows count as documents each; further columns are left out, whatever their names.
    """
    sized = docs.select(
        F.col(doc).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        word_count(F.col(text)).alias("size"),
    )
    with Scratch(docs.sparkSession) as scratch:
        sized = scratch.table(sized, "sizes")
        classes = scratch.table(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "classes")
        per_source = classes.groupBy("source").agg(
            F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs")
        )
        goals = targets(per_source, weights, cap).join(
            per_source.select(F.col("source").alias("s"), "docs"), F.col("source").eqNullSafe(F.col("s"))
        ).drop("s")
        goals = scratch.table(goals.withColumn("mean", F.col("source_size") / F.col("docs")), "goals")
        tilts = _solve(scratch, classes.where("size > 0"), goals, cap)
        planned = scratch.table(_plan(classes.where("size > 0"), tilts, cap), "planned")
        planned = _repair(scratch, planned, cap)
        taken = _deal(sized.where("size > 0"), planned, cap).unionByName(
            sized.where("size = 0").select(
                "doc_id", "source", "size", F.lit(0.0).alias("rate"), F.lit(0).cast("long").alias("copies")
            )
        )
        goal = goals.select(F.col("source").alias("s"), "source_size", "target")
        return settle(
            taken.join(goal, F.col("source").eqNullSafe(F.col("s"))).select(
                "doc_id", "source", "size", "source_size", "target", "rate", "copies"
            )
        )


def _rate(lam: Column, x: Column, cap: int) -> Column:
    # The exponent is cut where the cap has long been reached, against overflow.
    return F.least(F.lit(float(cap)), F.exp(F.least(lam * x, F.lit(50.0))))


def _solve(scratch: Scratch, classes: DataFrame, goals: DataFrame, cap: int) -> DataFrame:
    """Tilt ``lam`` of each source with words: Newton steps on the dual, kept in a bracket.

    The words taken rise with ``lam``, so each evaluation also narrows the bracket; a
    Newton step that leaves it becomes a bisection. A target of ``cap`` times the size is
    met in the limit; ``lam`` then stops where the smallest document is capped.
    """
    state = goals.where("source_size > 0").select(
        "source",
        "target",
        "mean",
        F.lit(0.0).alias("lam"),
        # At these ends nothing, or everything cap times, is taken.
        (-60.0 * F.col("mean")).alias("low"),
        (F.lit(2.0) * cap * F.col("mean")).alias("high"),
    )
    size, n = F.col("size").cast("double"), F.col("n").cast("double")
    for _ in range(STEPS):
        x = size / F.col("mean")
        rate = _rate(F.col("lam"), x, cap)
        slope = F.when(rate < cap, rate * x).otherwise(0.0)
        joined = classes.join(state.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        sums = joined.groupBy("source").agg(
            # Decimals add up the same in any order, so reruns agree to the last digit.
            F.sum((n * size * rate).cast("decimal(38,6)")).cast("double").alias("words"),
            F.sum((n * size * slope).cast("decimal(38,6)")).cast("double").alias("slope"),
            *[F.first(c).alias(c) for c in ("target", "mean", "lam", "low", "high")],
        )
        gap = F.col("words") - F.col("target")
        low = F.when(gap < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(gap >= 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - gap / F.when(F.col("slope") > 0, F.col("slope"))
        done = (F.abs(gap) <= CLOSE * F.col("target")) | (high - low <= 1e-12 * F.abs(high))
        lam = (
            F.when(done, F.col("lam"))
            .when((newton > low) & (newton < high), newton)
            .otherwise((low + high) / 2)
        )
        state = scratch.table(
            sums.select("source", "target", "mean", lam.alias("lam"), low.alias("low"), high.alias("high"), done.alias("done")),
            "tilts",
        )
        if state.where(~F.col("done")).isEmpty():
            break
    return state.select("source", "target", "mean", "lam")


def _plan(classes: DataFrame, tilts: DataFrame, cap: int) -> DataFrame:
    """Copies of each (source, size) class: cumulative rates in order of size, rounded.

    The rounding error is less than one copy before every size, so less than the largest
    document in words.
    """
    by_size = Window.partitionBy("source").orderBy("size")
    rated = classes.join(tilts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rated = rated.withColumn("rate", _rate(F.col("lam"), F.col("size") / F.col("mean"), cap))
    upto = F.sum(F.col("rate") * F.col("n")).over(by_size)
    whole = rated.withColumn("upto", F.round(upto).cast("long"))
    before = F.coalesce(F.lag("upto").over(by_size), F.lit(0))
    copies = F.greatest(F.lit(0), F.least(F.col("upto") - before, cap * F.col("n")))
    return whole.select("source", "size", "n", "target", "rate", copies.cast("long").alias("k"))


def _repair(scratch: Scratch, planned: DataFrame, cap: int) -> DataFrame:
    """Move copies of one class a round towards the target: the largest size that fits the gap."""
    for _ in range(REPAIRS):
        gaps = planned.groupBy("source").agg(
            (F.first("target") - F.sum(F.col("size") * F.col("k"))).alias("gap")
        )
        gaps = scratch.table(gaps.where(F.abs("gap") >= 1), "gaps")
        if gaps.isEmpty():
            break
        room = F.when(F.col("gap") > 0, cap * F.col("n") - F.col("k")).otherwise(F.col("k"))
        fits = planned.join(
            gaps.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))
        ).where((room > 0) & (F.col("size") <= F.abs("gap")))
        best = fits.groupBy("source").agg(
            F.max(F.struct("size", room.alias("room"), "gap")).alias("best")
        ).select(
            F.col("source").alias("s"),
            F.col("best.size").alias("z"),
            (F.signum("best.gap") * F.least(F.col("best.room"), F.floor(F.abs("best.gap") / F.col("best.size"))))
            .cast("long")
            .alias("change"),
        )
        best = scratch.table(best, "best")
        moved = planned.join(best, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")), "left")
        planned = scratch.table(
            moved.select("source", "size", "n", "target", "rate", (F.col("k") + F.coalesce("change", F.lit(0))).alias("k")),
            "planned",
        )
    return planned


def _deal(sized: DataFrame, planned: DataFrame, cap: int) -> DataFrame:
    """Deal the copies of each class to its documents: all get the whole share, some one more.

    A large class is cut into slices by hash, and its extra copies are spread over them by
    cumulative counts, so neither a join key nor a window holds a whole large class.
    """
    order = F.xxhash64(F.col("doc_id").cast("string"))
    spread = planned.withColumn("slices", F.ceil(F.col("n") / SLICE).cast("long")).withColumnsRenamed(
        {"source": "s", "size": "z"}
    )
    rows = sized.join(spread, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).select(
        "doc_id", "source", "size", "n", "k", "rate", order.alias("h"), F.pmod(F.xxhash64(order), F.col("slices")).alias("slice")
    )
    extra = F.pmod(F.col("k"), F.col("n"))
    share = F.floor(F.col("k") / F.col("n")).cast("long")
    per_slice = rows.groupBy("source", "size", "slice").agg(
        F.count(F.lit(1)).alias("m"), F.first("n").alias("n"), F.first("k").alias("k")
    )
    upto = F.sum("m").over(Window.partitionBy("source", "size").orderBy("slice"))
    # Extra copies of the slices up to one: their part of all, rounded down.
    until = F.floor(upto.cast("decimal(38,0)") * extra / F.col("n"))
    since = F.floor((upto - F.col("m")).cast("decimal(38,0)") * extra / F.col("n"))
    quota = per_slice.select(
        F.col("source").alias("s"), F.col("size").alias("z"), F.col("slice").alias("c"), (until - since).cast("long").alias("quota")
    )
    rank = F.row_number().over(Window.partitionBy("source", "size", "slice").orderBy("h", "doc_id"))
    ranked = rows.withColumn("rank", rank).withColumn("share", share)
    return ranked.join(
        quota,
        F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("slice") == F.col("c")),
    ).select(
        "doc_id",
        "source",
        "size",
        "rate",
        (F.col("share") + F.when(F.col("rank") <= F.col("quota"), 1).otherwise(0)).cast("long").alias("copies"),
    )


def take(docs: DataFrame, copies: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``docs`` with every row as many times as ``copies`` (doc_id, copies) says; the others go.

    Ids must name rows: one that is there twice raises when the result is read, and rows
    without one are not taken. ``mixed`` takes such tables as well.
    """
    columns = docs.columns
    id_, times, copy = (spare(docs, n) for n in ("_doc", "_copies", "_copy"))
    counted = copies.groupBy(F.col("doc_id").alias(id_)).agg(
        F.count(F.lit(1)).alias("n"), F.max("copies").cast("int").alias(times)
    )
    unclear = F.raise_error(F.lit("copies of a repeated id"))
    checked = F.when(F.col("n") > 1, unclear.cast("int")).otherwise(F.col(times))
    wanted = counted.select(id_, checked.alias(times)).where(F.col(times) > 0)
    return (
        docs.join(wanted, F.col(doc) == F.col(id_))
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
        .select(*columns)
    )


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    cap: int = 3,
    doc: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``docs`` with every row as many times as the mix takes it.

    Rows are documents each, also where their ids repeat or are NULL: the rows of such a
    table are numbered and written out once, and go by their numbers.
    """
    id_ = F.col(doc)
    unique = docs.groupBy(id_).agg(F.count(F.lit(1)).alias("n")).where(id_.isNull() | (F.col("n") > 1)).isEmpty()
    if unique:
        copies = mix(docs.select(doc, source, text), weights, cap, doc, source, text)
        return take(docs, copies.select("doc_id", "copies"), doc)
    number = spare(docs, "_number")
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.table(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
        copies = mix(rows.select(number, source, text), weights, cap, number, source, text)
        return settle(take(rows, copies.select("doc_id", "copies"), number).select(*docs.columns))

