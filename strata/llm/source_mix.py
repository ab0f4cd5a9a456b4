"""Mixing sources to target weights by entropy balancing.

Every document gets a rate. Among all rates between 0 and the cap that give
each source its target of words, entropy balancing takes those closest in
relative entropy to taking every document once. They are exponentially tilted:
``min(cap, exp(lambda * size))``, with one multiplier for each constraint, so
a source that has to grow takes more of its long documents, one that has to
shrink fewer. The multipliers minimise the convex dual, whose gradient is the
words taken less the target and whose curvature comes from the documents below
the cap. Newton rounds find them for all sources at once: a round gathers both
sums over the documents, as counts per (source, size), in one Spark aggregate;
a step that leaves the bracket known so far is replaced by its middle.

Rates are rounded into whole copies along a running sum, so that each source's
words stay close to its target, and the rest is made up by corrections.

Everything is DataFrame expressions. A source may hold most rows: sums are
folded map-side, running sums go over its sizes in ranges, and rows that agree
in everything are counted before they are numbered. Sums that decide copies are
exact (decimal), so reruns agree whatever the order of partial sums.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialise

WORDS = r"[^\x20\x09-\x0D]+"
# Buckets that rows of one source and size, and equal rows among themselves, are numbered in.
BUCKETS = 64
# Sizes of a range of the running sum.
SIZE_RANGE = 256
# Newton rounds at most, and the relative error of a source's words that ends them.
ROUNDS, TOLERANCE = 80, 1e-9
# Rounds that first rate a source's small documents anew and then move the one document that fits best.
CORRECTIONS = 3


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """(source, source_size, target) from rows of (source, source_size).

    Sources by code point, null last, take the weights in turn and share all
    words. A target stops at ``cap`` times its source's size and the excess is
    reshared by weight: the shares are ``min(cap * size, level * weight)``, and
    the level follows from running sums over sources by the size per weight
    at which they fill.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    weighed = (sizes.withColumn("weight", F.element_at(pattern, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
               .withColumn("limit", F.col("source_size") * F.lit(float(cap))))
    # Filled sources come first; the level is what the rest share once they are taken out.
    filling = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything).cast("double")
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    left_words = total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    levels = weighed.withColumn("level", left_words / left_weight).withColumn("place", F.row_number().over(filling))
    # The level is final at the first source that it does not fill.
    final = F.min(F.when(F.col("limit") >= F.col("level") * F.col("weight"), F.struct("place", "level"))).over(everything)
    levels = levels.withColumn("final", final)
    return levels.select("source", "source_size", F.least(
        F.col("limit"), F.coalesce(F.col("final.level"), F.lit(0.0)) * F.col("weight")).alias("target"))


def _state(sources: DataFrame, cells: DataFrame, cap: float) -> DataFrame:
    """Where the rounds start: multiplier 0, and a bracket that holds it.

    Sizes are divided by their mean. At ``low`` even single words have a rate of
    exp(-50), at ``high`` all documents are at the cap. A source whose target is
    all its words at the cap has no finite multiplier; one without words needs none.
    """
    scale = cells.where(F.col("size") > 0).groupBy(F.col("source").alias("of")).agg(
        (F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("scale"))
    filled = F.col("target") >= F.lit(cap * (1 - 1e-12)) * F.col("source_size")
    return (sources.join(scale, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
            .withColumn("lambda", F.when(~filled & (F.col("source_size") > 0) & (F.col("target") > 0), 0.0))
            .withColumn("low", F.col("scale") * -50.0).withColumn("high", F.col("scale") * math.log(cap) + 1.0)
            .withColumn("done", F.col("lambda").isNull()))


def _tilt(cap: float) -> Column:
    """The uncapped rate of a size; exponents stop a little above the cap, so that none overflows."""
    return F.exp(F.least(F.col("lambda") * F.col("size") / F.col("scale"), F.lit(math.log(cap) + 1.0)))


def newton_round(state: DataFrame, cells: DataFrame, cap: float) -> DataFrame:
    """One step for every source that is not done: a gather over all sizes, then a safeguarded step.

    The step solves for the logarithm of the words taken, which is close to linear in the multiplier.
    """
    same = F.col("source").eqNullSafe(F.col("of"))
    held = cells.withColumnRenamed("source", "of").join(state.where(~F.col("done")), same).where(F.col("size") > 0)
    held = held.withColumn("tilt", _tilt(cap))
    exact = "decimal(38,9)"
    words = (F.col("n") * F.least(F.col("tilt"), F.lit(cap)) * F.col("size")).cast(exact)
    bend = F.when(F.col("tilt") < cap, (F.col("n") * F.col("tilt") * F.col("size") * F.col("size") / F.col("scale")).cast(exact))
    sums = held.groupBy("of").agg(F.sum(words).cast("double").alias("words"), F.coalesce(F.sum(bend), F.lit(0)).cast("double").alias("bend"))
    at, target = F.col("lambda"), F.col("target")
    low = F.when(F.col("words") < target, at).otherwise(F.col("low"))
    high = F.when(F.col("words") > target, at).otherwise(F.col("high"))
    moved = state.join(sums, same, "left").drop("of").withColumns({"low": low, "high": high})
    newton = at - F.log(F.col("words") / target) * F.col("words") / F.when(F.col("bend") > 0, F.col("bend"))
    inside = (newton > F.col("low")) & (newton < F.col("high"))
    near = F.abs(F.col("words") - target) <= F.lit(TOLERANCE) * target
    step = F.when(F.coalesce(inside, F.lit(False)), newton).otherwise((F.col("low") + F.col("high")) / 2)
    return moved.withColumns({"lambda": F.when(F.col("done") | near, at).otherwise(step), "done": F.col("done") | F.coalesce(near, F.lit(False))}).drop("words", "bend")


def newton_multipliers(sources: DataFrame, cells: DataFrame, cap: float) -> DataFrame:
    """Adds ``lambda`` and ``scale``: rates ``min(cap, exp(lambda * size / scale))`` give each source its target.

    ``sources`` has (source, source_size, target), ``cells`` (source, size, n). Null where every
    document is at the cap, or none has words.
    """
    spark = sources.sparkSession
    state = materialise(spark, _state(sources, cells, cap), "mix-dual")
    for _ in range(ROUNDS):
        if state.where(~F.col("done")).isEmpty():
            break
        state = materialise(spark, newton_round(state, cells, cap), "mix-dual")
    return state.drop("low", "high", "done")


def _running(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """Adds ``<value>_before``: its sum over the source's larger sizes, by ranges of sizes and then inside them."""
    df = df.withColumn("range", F.expr(f"size div {SIZE_RANGE}"))
    inside = Window.partitionBy("source", "range").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("of").orderBy(F.desc("r")).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(F.col("source").alias("of"), F.col("range").alias("r")).agg(*[F.sum(v).alias(f"all_{v}") for v in values])
    totals = totals.select("of", "r", *[F.coalesce(F.sum(f"all_{v}").over(across), F.lit(0)).alias(f"over_{v}") for v in values])
    own = df.withColumns({f"own_{v}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    joined = own.join(totals, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("r")))
    return joined.select(*[c for c in df.columns if c != "range"], *[(F.col(f"own_{v}") + F.col(f"over_{v}")).alias(f"{v}_before") for v in values])


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """Inner join on equal names, nulls equal; the right side's names go."""
    renamed = right.select(*[F.col(c).alias(f"_{c}") if c in names else F.col(c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names])
    return left.join(renamed, condition).drop(*[f"_{c}" for c in names])


def _places(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``place`` of every row among those of its source and size, from 1.

    Rows that agree in id and text are one group with a number; only the few groups of more than one
    have their rows numbered, in buckets.
    """
    key = ["source", "size", "id", "text_key"]
    bucketed = groups.withColumn("bucket", F.pmod(F.xxhash64("id", "text_key"), F.lit(BUCKETS)))
    cells = bucketed.groupBy("source", "size", "bucket").agg(F.sum("n").alias("held"))
    earlier = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("source", "size", "bucket", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("cell_before"))
    inside = Window.partitionBy("source", "size", "bucket").orderBy(F.asc_nulls_first("id"), "text_key").rowsBetween(Window.unboundedPreceding, -1)
    ahead = bucketed.withColumn("ahead", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    ahead = _same(ahead, cells, ["source", "size", "bucket"]).select(*key, "n", (F.col("ahead") + F.col("cell_before")).alias("base"))
    based = _same(rows, ahead, key)
    singles = based.where(F.col("n") == 1).select("row", *key, (F.col("base") + 1).alias("place"))
    many = based.where(F.col("n") > 1).withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(BUCKETS)))
    salts = many.groupBy(*key, "salt").agg(F.count(F.lit(1)).alias("held"))
    over = Window.partitionBy(*key).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    salts = salts.select(*key, "salt", F.coalesce(F.sum("held").over(over), F.lit(0)).alias("salt_before"))
    numbered = many.withColumn("number", F.row_number().over(Window.partitionBy(*key, "salt").orderBy("row")))
    numbered = _same(numbered, salts, [*key, "salt"])
    return singles.unionByName(numbered.select("row", *key, (F.col("base") + F.col("salt_before") + F.col("number")).alias("place")))


def mix_sources(docs: DataFrame, weights: Sequence[float], cap: float = 3.0, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, ``source``, ``size``, ``source_size``, ``target``, ``rate``, ``copies``, ``taken``.

    ``size`` counts words (null text: 0), ``taken`` is ``copies * size`` and at
    most ``cap`` times the size. A null source is a source of its own, the
    last. Documents without words are taken once, which costs no words. Equal
    rows are numbered among themselves, so each has a row and reruns agree.
    Null ids are ids like any other; a long text is its count and digest. If no
    document has a word, all targets are 0. An empty table gives an empty
    result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    mixed = _mixed(rows.withColumn("row", F.monotonically_increasing_id()), weights, cap)
    return mixed.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "rate",
                        "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _mixed(rows: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """(row, id, source, size, source_size, target, rate, copies) for rows of (row, id, text, source)."""
    spark, cap = rows.sparkSession, float(cap)
    measured = materialise(spark, rows.select("row", "id", "source", word_count(F.col("text")).alias("size"),
                                              F.coalesce(F.md5("text"), F.lit("")).alias("text_key")), "mix-sizes")
    groups = measured.groupBy("source", "size", "id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    cells = materialise(spark, measured.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-cells")
    sizes = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    sources = newton_multipliers(source_targets(sizes, weights, cap), cells, cap)
    # Rates of nine digits: their running sums are exact.
    rate = (F.when(F.col("size") == 0, 1.0).when(F.col("lambda").isNotNull(), F.least(F.lit(cap), _tilt(cap)))
            .when(F.col("target") > 0, cap).otherwise(0.0))
    rated = _same(cells, sources, ["source"]).withColumn("rate", F.round(rate, 9))
    rated = rated.withColumn("rest", (F.col("n") * (F.col("rate") - F.floor("rate")).cast("decimal(10,9)")).cast("decimal(38,9)"))
    along = _running(rated, ["n", "rest"]).select("source", "size", "source_size", "target", "rate", "n_before", "rest_before")
    placed = _same(_places(measured, groups).drop("text_key"), along, ["source", "size"])
    part = (F.col("rate") - F.floor("rate")).cast("decimal(10,9)")
    half = F.lit("0.5").cast("decimal(2,1)")
    until = lambda place: F.floor((F.col("rest_before") + (part * place).cast("decimal(38,9)")).cast("decimal(38,9)") + half)
    # Whole copies of the rate's whole part; one more for every step of the running sum of the rest.
    copies = (F.floor("rate") + until(F.col("place")) - until(F.col("place") - 1)).cast("long")
    mixed = materialise(spark, placed.select("row", "id", "source", "size", "source_size", "target", "rate",
                                             (F.col("n_before") + F.col("place")).alias("rank"), copies.alias("copies")), "mix-copies")
    for _ in range(CORRECTIONS):
        mixed = materialise(spark, _rated_anew(mixed, cap), "mix-copies")
        mixed = materialise(spark, _corrected(mixed, cap), "mix-copies")
    return mixed


def _rounded(rate: Column, rank: Column) -> Column:
    """Whole copies for a rate: its whole part, and one more at every step of the running sum of the rest."""
    part = rate - F.floor(rate)
    return (F.floor(rate) + F.floor(part * rank + 0.5) - F.floor(part * (rank - 1) + 0.5)).cast("long")


def _errors(mixed: DataFrame) -> DataFrame:
    """(of, error): words that each source still lacks (or has too many of, below zero)."""
    error = mixed.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("error"))
    return error.withColumnRenamed("source", "of")


def _rated_anew(mixed: DataFrame, cap: float) -> DataFrame:
    """Let a source's documents no larger than its error make up for it.

    They get the rate that would, and are rounded anew; as they are the last in
    rank, rounding leaves at most half the largest of them, so the error halves
    at least wherever they have the words.
    """
    same = F.col("source").eqNullSafe(F.col("of"))
    small = (F.col("size") > 0) & (F.col("size") <= F.abs("error"))
    sums = (mixed.join(_errors(mixed), same).where(small).groupBy("of").agg(
        F.first("error").alias("error"), F.sum("size").alias("words"), F.sum(F.col("copies") * F.col("size")).alias("taken")))
    rates = sums.select("of", "error", F.greatest(F.lit(0.0), F.least(
        F.lit(float(cap)), (F.col("taken") + F.col("error")) / F.col("words"))).alias("anew"))
    return mixed.join(rates, same, "left").select(
        *[c for c in mixed.columns if c != "copies"],
        F.when(F.coalesce(small, F.lit(False)), _rounded(F.col("anew"), F.col("rank"))).otherwise(F.col("copies")).alias("copies"))


def take_copies(docs: DataFrame, weights: Sequence[float], cap: float = 3.0, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns.

    Rows get a number of their own and are written once with it; the copies are joined back by
    that number, row by row, so rows that agree in id, or have none, stay spread.
    """
    names = docs.columns
    numbered = docs.select(F.struct(*[F.col(c) for c in names]).alias("doc"), F.monotonically_increasing_id().alias("row"))
    written = materialise(docs.sparkSession, numbered, "mix-rows")
    mixed = _mixed(written.select("row", F.col(f"doc.{id_col}").alias("id"), F.col(f"doc.{text_col}").alias("text"),
                                  F.col(f"doc.{source_col}").alias("source")), weights, cap)
    copies = mixed.where(F.col("copies") > 0).select(F.col("row").alias("of"), "copies")
    taken = written.join(copies, F.col("row") == F.col("of")).select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select("doc.*")


def _corrected(mixed: DataFrame, cap: float) -> DataFrame:
    """Give or take one copy of the document whose size fits its source's error best, where that helps."""
    error = _errors(mixed)
    same = F.col("source").eqNullSafe(F.col("of"))
    able = F.when(F.col("error") > 0, F.col("copies") + 1 <= F.lit(cap)).otherwise(F.col("copies") >= 1)
    miss = F.abs(F.abs("error") - F.col("size"))
    best = (mixed.join(error, same).where(able & (F.col("size") > 0) & (miss < F.abs("error")))
            .groupBy("of").agg(F.min(F.struct(miss.alias("miss"), "rank")).alias("best"), F.first("error").alias("error")))
    best = best.select("of", F.col("best.rank").alias("at"), F.signum("error").cast("long").alias("change"))
    return mixed.join(best, same & (F.col("rank") == F.col("at")), "left").select(
        *[c for c in mixed.columns if c != "copies"], (F.col("copies") + F.coalesce("change", F.lit(0))).alias("copies"))
