"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Targets. The sources share all words by weight; a source takes at most ``most`` times its own words, and what it
leaves is shared again by weight among the others until none is above. That is ``target = least(most * size, level *
weight)``, and the level is found by repeating the sharing; each round is one aggregate of two sums.

Rates. Each document of a source gets a rate, as near as possible to 1 in relative entropy, such that the rates give
the target number of words: ``rate = least(most, exp(theta * size / mean size))``. One theta for each source solves the
convex dual. Newton's steps for all sources at once are aggregates over a histogram of (source, size); a step that
leaves the bracket becomes a bisection. Sums are exact decimals, so a rerun gives the same thetas.

Copies. A rate's whole part is taken for sure. Of the fractional parts as many documents are rounded up as the
source's target still asks for, in the order of (uniform hash / fractional part), which takes a document with a
probability close to its fraction. The cut is found by a histogram of that order and an exact sort of the
one bin it falls in, so the largest source needs no sort of all its documents. Then, twice, the one document of each
source whose rounding the other way brings its words nearest to the target is turned.

Defined cases: null, empty and blank texts have size 0, are taken once and count nothing; a null source is a source
of its own and sorts last; sources without words have target 0; repeated rows share their fate up to the document at the
cut; an empty table gives an empty result; other columns are kept by ``mixed``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.llm.tables import discard, stored, unused

WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3
TOLERANCE = 1e-7
_MOST_STEPS = 64
_BINS = 4096
_FLIPS = 2


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def rates(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """Of each row its doc_id, source, size and mark (a uniform hash); of each source its size, target, theta and cut."""
    base = docs.select(
        F.col("doc_id"), F.col("source"), words(F.col("text")).alias("size"), _uniform(F.col("doc_id"), F.col("text")).alias("mark")
    )
    base = stored(base, "mix-sizes")
    sources = stored(_targets(base, weights, most), "mix-sources")
    thetas = _thetas(base, sources, most)
    return base, stored(_cuts(base, thetas, most), "mix-cuts")


def _uniform(*columns: Column) -> Column:
    """Above 0 and below 1, by hash."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11) + 0.5) / float(1 << 53)


def _ranked(df: DataFrame, *order: Column) -> DataFrame:
    """``rank`` from 1 by the order given, without sorting all rows in one task."""
    parts = stored(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-ranges")
    counts = parts.groupBy("part").count()  # a row for each partition
    before = counts.select("part", (F.sum("count").over(W.orderBy("part")) - F.col("count")).alias("before"))
    own = F.row_number().over(W.partitionBy("part").orderBy(*order))
    return parts.withColumn("own", own).join(before, "part").withColumn("rank", F.col("own") + F.col("before")).drop("part", "own", "before")


def _targets(base: DataFrame, weights: tuple[float, ...], most: int) -> DataFrame:
    sums = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.when(F.col("size") > 0, 1).otherwise(0)).alias("n"))
    ranked = _ranked(sums, F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int") + 1)
    ranked = stored(ranked.withColumn("weight", weight).drop("rank"), "mix-weights")
    total, level, before = ranked.agg(F.sum("source_size")).first()[0] or 0, 0.0, None
    while True:
        full = F.lit(False) if before is None else most * F.col("source_size") <= level * F.col("weight")
        capped, free, n = ranked.agg(
            F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight"))), F.sum(full.cast("int"))
        ).first()
        if n == before or not free:
            break
        level, before = (total - most * (capped or 0)) / free, n
    return ranked.withColumn("target", F.least(F.col("source_size") * float(most), level * F.col("weight")))


def _rate(most: int) -> Column:
    tilted = F.least(F.lit(float(most)), F.exp(F.col("theta") * F.col("size") / F.col("mean")))
    return F.when(F.col("full"), float(most)).otherwise(tilted)


def _thetas(base: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    histogram = stored(base.where("size > 0").groupBy("source", "size").count(), "mix-histogram")
    ratio = F.col("target") / F.col("source_size")
    state = sources.where("source_size > 0").select(
        "source", "source_size", "target", (F.col("source_size") / F.col("n")).alias("mean"), (ratio >= most * (1 - 1e-12)).alias("full"),
        F.lit(0.0).alias("theta"),
        F.when(ratio < 1, F.log(ratio) * F.col("source_size") / F.col("n")).otherwise(0.0).alias("low"),
        F.when(ratio > 1, F.log(F.lit(float(most))) * F.col("source_size") / F.col("n")).otherwise(0.0).alias("high"),
        F.lit(None).cast("double").alias("miss"),
    )
    before = None
    for _ in range(_MOST_STEPS):  # one plan for each step, so that none grows with their number
        state = stored(_newton(state, histogram, most), "mix-thetas")
        discard(before)
        before = state
        worst = state.agg(F.max("miss")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
    return state


def _newton(state: DataFrame, histogram: DataFrame, most: int) -> DataFrame:
    rows = _by_source(histogram, state.drop("miss"))  # the only join of a step: each is a broadcast that the driver builds
    share = F.col("count") * F.col("size") * _rate(most)
    slope = F.when(_rate(most) < most, share * F.col("size") / F.col("mean")).otherwise(0.0)
    now = rows.groupBy("source").agg(
        *_same(state.drop("miss")), F.sum(share.cast("decimal(38,8)")).cast("double").alias("got"), F.sum(slope.cast("decimal(38,8)")).cast("double").alias("slope")
    )
    over = F.col("got") > F.col("target")
    low = F.when(over, F.col("low")).otherwise(F.col("theta"))
    high = F.when(over, F.col("theta")).otherwise(F.col("high"))
    step = F.col("theta") - F.try_divide(F.col("got") - F.col("target"), F.col("slope"))
    miss = F.when(F.col("full"), 0.0).otherwise(F.abs(F.col("got") - F.col("target")) / F.col("target"))
    inside = (step > low) & (step < high)
    theta = F.when(F.col("full") | (miss <= TOLERANCE), F.col("theta")).when(inside, step).otherwise((low + high) / 2)
    return now.select("source", "source_size", "target", "mean", "full", theta.alias("theta"), low.alias("low"), high.alias("high"), miss.alias("miss"))


def _by_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joined by source, where null is equal to null. The right side has a row for each source."""
    key = f"source_{uuid.uuid4().hex[:8]}"
    right = right.withColumnRenamed("source", key)
    return left.join(right, left["source"].eqNullSafe(right[key]), how).drop(key)


def _same(sources: DataFrame) -> list[Column]:
    """Aggregates that hand on what is the same in all rows of a source."""
    return [F.first(c).alias(c) for c in sources.columns if c != "source"]


def _with_found(sources: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """``sources`` with ``name`` out of ``found`` (source, name), null where that has no row: by grouping, without a join."""
    rows = sources.drop(name).unionByName(found.select("source", name), allowMissingColumns=True)
    return rows.groupBy("source").agg(*[F.first(c, ignorenulls=True).alias(c) for c in rows.columns if c != "source"])


def _parts(most: int) -> tuple[Column, Column, Column]:
    """Whole copies, the place in the order of rounding up (null if there is nothing to round), and its bin."""
    rate = _rate(most)
    whole = F.floor(rate)
    place = F.when(rate > whole, F.col("mark") / (rate - whole))
    return whole, place, F.floor(_BINS * place / (1 + place)).cast("int")


def _cuts(base: DataFrame, thetas: DataFrame, most: int) -> DataFrame:
    whole, place, bin_ = _parts(most)
    thetas = thetas.drop("miss")
    rows = _by_source(base.where("size > 0"), thetas)
    # At most _BINS rows of a source, and one for the documents that have nothing to round.
    bins = rows.groupBy("source", bin_.alias("bin")).agg(
        *_same(thetas), F.sum(whole * F.col("size")).alias("whole"), F.sum(F.when(place.isNotNull(), F.col("size")).otherwise(0)).alias("words")
    )
    own = W.partitionBy("source")
    bins = bins.withColumn("left", F.max("target").over(own) - F.sum("whole").over(own))
    bins = bins.withColumn("before", F.sum("words").over(own.orderBy("bin")) - F.col("words"))
    here = F.expr("bin IS NOT NULL AND before <= left AND before + words > left")
    cut = bins.groupBy("source").agg(*_same(thetas), F.first("left").alias("left"), *[F.max(F.when(here, F.col(c))).alias(n) for c, n in (("before", "before"), ("bin", "at"))])
    cut = stored(cut, "mix-at")
    inside = _by_source(base.where("size > 0"), cut).withColumn("place", place).where(place.isNotNull() & (bin_ == F.col("at")))
    ordered = inside.withColumn("upto", F.col("before") + F.sum("size").over(W.partitionBy("source").orderBy("place", "size").rowsBetween(W.unboundedPreceding, 0)))
    last = ordered.where("upto - size / 2 <= left").groupBy("source").agg(F.max("place").alias("last"))
    # Sources whose order never reaches what is left round up everything; a cut before the first of its bin rounds up all bins before.
    cuts = _with_found(cut.drop("left", "before"), last, "last").withColumns({f"flip{k}": F.lit(None).cast("double") for k in range(_FLIPS)})
    for k in range(_FLIPS):
        cuts = _flipped(base, stored(cuts, "mix-flips"), k, most)
    return cuts


def _flipped(base: DataFrame, cuts: DataFrame, k: int, most: int) -> DataFrame:
    """One more document of each source rounded the other way, where that brings the source nearer to its target."""
    rows = _by_source(base.where("size > 0"), cuts)
    taken = stored(rows.groupBy("source").agg(*_same(cuts), (F.max("target") - F.sum(_copies(rows, most) * F.col("size"))).alias("miss")), "mix-missed")
    change = F.when(_up(most), -F.col("size")).otherwise(F.col("size"))
    unused = F.coalesce(*[F.col("mark") == F.col(f"flip{i}") for i in range(k)], F.lit(False)) if k else F.lit(False)
    free = _by_source(base.where("size > 0"), taken).where(_parts(most)[1].isNotNull() & ~unused).withColumn("then", F.abs(F.col("miss") - change))
    best = free.where("then < abs(miss)").groupBy("source").agg(F.min(F.struct("then", "mark"))["mark"].alias(f"flip{k}"))
    return _with_found(taken.drop("miss"), best, f"flip{k}")


def _up(most: int) -> Column:
    """Whether a rate is rounded up."""
    _, place, bin_ = _parts(most)
    up = place.isNotNull() & (F.col("at").isNull() | (bin_ < F.col("at")) | F.coalesce((bin_ == F.col("at")) & (place <= F.col("last")), F.lit(False)))
    for k in range(_FLIPS):
        up = up != F.coalesce(place.isNotNull() & (F.col("mark") == F.col(f"flip{k}")), F.lit(False))
    return up


def _copies(rows: DataFrame, most: int) -> Column:
    whole = _parts(most)[0]
    return F.when((F.col("size") == 0) | F.col("mean").isNull(), 1).otherwise(whole + _up(most).cast("int")).cast("int")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, rate for each row of ``docs``."""
    base, cuts = rates(docs, weights, most)
    rows = _by_source(base, cuts, "left").withColumn("copies", _copies(base, most))
    return rows.select(
        F.col("doc_id"), "size", F.coalesce("source_size", F.lit(0)).cast("long").alias("source_size"), F.coalesce("target", F.lit(0.0)).alias("target"),
        (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies", F.coalesce(_rate(most), F.lit(1.0)).alias("rate"),
    )


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken, with ``copy`` (``_copy`` beside a column of that
    name, and so on) counting from 1."""
    _, cuts = rates(docs, weights, most)
    names = docs.columns
    facts = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("source").alias("source"), words(F.col("text")).alias("size"),
        _uniform(F.col("doc_id"), F.col("text")).alias("mark"),
    )
    rows = _by_source(facts, cuts, "left").withColumn("copies", _copies(facts, most)).where("copies > 0")
    copy = unused(docs, "copy")
    taken = rows.select("row", F.explode(F.sequence(F.lit(1), "copies")).alias("number"))
    return taken.select("row.*", F.col("number").alias(copy))
