"""Mixing sources to target weights by Pareto order sampling.

Every source gets a word target. A document's expected copies are its source's
scale times its own importance, at most MAX_COPIES; the whole part is taken for
certain, and the fraction is an inclusion probability. Documents are then ranked by
random odds over inclusion odds and taken in that order until the source's words
are reached. Nothing is sorted: the rank's cut is found by two histogram passes. Rows
equal in source, id and text are counted and numbered, and each number draws for itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, Scratch, free_name, row_digest, unit_hash

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_COPIES = 2
BINS = 4096
#: Importance of a document: 1 + min(log2(1 + words), CLASSES) / CLASSES, by whole classes.
CLASSES = 16
#: Repeated rows that one element of an array stands for.
RUN = 1 << 16


def _targets(sources: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """sources (src, words) with target: water-filling under target <= cap x words.

    In closed form: sources are capped in the order of cap x words / weight; the
    first that need not be capped fixes the level for all after it. One row per
    source, so its unpartitioned windows hold the sources and not the documents.
    """
    everything = W.partitionBy()
    n = len(weights)
    at = F.row_number().over(W.orderBy(F.col("src").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (at % n).cast("int"))
    t = sources.withColumn("weight", weight)
    t = t.withColumn("want", F.lit(share) * F.sum("words").over(everything)).withColumn("ratio", F.lit(float(cap)) * F.col("words") / F.col("weight"))
    up_to = W.orderBy("ratio", F.col("src").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    from_here = W.orderBy("ratio", F.col("src").asc_nulls_last()).rowsBetween(0, W.unboundedFollowing)
    t = t.withColumn("level", (F.col("want") - F.lit(float(cap)) * F.coalesce(F.sum("words").over(up_to), F.lit(0))) / F.sum("weight").over(from_here))
    first = F.struct("ratio", F.col("src").isNull(), "src", F.col("level").alias("at"))
    level = F.min(F.when(F.col("level") <= F.col("ratio"), first)).over(everything).getField("at")
    return t.withColumn("target", F.least(F.lit(float(cap)) * F.col("words"), F.coalesce(level, F.col("want")) * F.col("weight"))).select("src", "words", "target")


def _scales(classes: DataFrame, cap: float) -> DataFrame:
    """classes (src, class, imp, w, target), at most CLASSES + 1 rows of a source: with
    scale c so that the sum of min(cap, c * imp) * w is the target."""
    order = W.partitionBy("src").orderBy(F.col("imp").desc())
    rest = F.sum(F.col("imp") * F.col("w")).over(order.rowsBetween(0, W.unboundedFollowing))
    capped = F.coalesce(F.sum("w").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    c = F.when(rest > 0, (F.col("target") - cap * capped) / rest)
    classes = classes.withColumn("c", c)
    ok = F.when(F.col("c") * F.col("imp") <= cap * (1 + 1e-12), F.struct(-F.col("imp"), F.col("c").alias("c")))
    scale = F.min(ok).over(W.partitionBy("src")).getField("c")
    return classes.withColumn("copies", F.least(F.lit(float(cap)), F.coalesce(scale, F.lit(float(cap))) * F.col("imp")))


def mix(
    docs: DataFrame,
    *,
    text_col: str = "text",
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_copies: int = MAX_COPIES,
    seed: int = 20,
    keys: tuple[str, ...] = (),
    scratch: Scratch | None = None,
) -> DataFrame:
    """How much of each document a mix takes.

    Size is the number of words of the text (null: 0). Sources in code-point order,
    null last, have ``weights`` in turn; they share ``share`` x all words; no target is
    above ``max_copies`` x its source, the excess goes to the others by weight.

    Returns id, size, source_size, target, taken (words, repeats counted), copies and the
    columns ``keys`` (rows that differ in them are not repeats of each other). Empty and
    null texts have size 0 and are taken once at most; rows equal in source, id and text
    are numbered and draw apart, so that a source of one repeated row is cut like any
    other; null ids and sources are values like others; a source of size 0 has target 0;
    an empty table gives an empty result; other columns do not matter. Draws are hashes of
    id, text digest, number and seed, so reruns agree.
    """
    scratch = scratch or Scratch(docs.sparkSession, "mix")
    cap = float(max_copies)
    size = F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("bigint")
    base = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source_col}`").alias("src"),
        size.alias("size"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("digest"),
        *[F.col(f"`{c}`").alias(f"key_{i}") for i, c in enumerate(keys)],
    )
    equal = base.groupBy(*base.columns).agg(F.count("*").alias("m"))
    # numbers 0 .. m - 1, in runs that no array is longer than
    equal = equal.withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("m") - 1) / F.lit(RUN)))))
    last = F.least(F.lit(RUN).cast("bigint"), F.col("m") - F.col("run") * RUN) - 1
    base = equal.withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).withColumn("k", F.col("run") * RUN + F.col("k")).drop("m", "run")
    base = scratch.keep(base.withColumn("class", F.least(F.floor(F.log2(F.col("size") + F.lit(1.0))), F.lit(CLASSES)).cast("int")))
    classes = base.groupBy("src", "class").agg(F.sum("size").alias("w"))
    sources = classes.groupBy("src").agg(F.sum("w").alias("words"))
    targets = _targets(sources, weights, share, cap)
    imp = 1.0 + F.col("class") / F.lit(float(CLASSES))
    targets = targets.withColumnRenamed("src", "t_src")
    per_class = classes.join(targets, F.col("src").eqNullSafe(F.col("t_src"))).select("src", "class", "w", "words", "target", imp.alias("imp"))
    plan = _scales(per_class, cap)
    whole = F.floor("copies")
    plan = scratch.keep(
        plan.withColumn("certain", whole.cast("bigint"))
        .withColumn("odds", F.col("copies") - whole)
        .withColumn("due", F.sum(F.col("odds") * F.col("w")).over(W.partitionBy("src")))
        .select(F.col("src").alias("s_"), F.col("class").alias("c_"), F.col("words").alias("source_size"), "target", "certain", "odds", "due")
    )
    u = unit_hash("id", "digest", "k", seed=seed)
    # odds over odds, mapped to (0, 1): monotone, so the order is the Pareto order
    p = F.col("odds")
    rank = (u * (1 - p)) / (u * (1 - p) + (1 - u) * p)
    ranked = (
        base.join(plan, F.col("src").eqNullSafe(F.col("s_")) & (F.col("class") == F.col("c_")))
        .drop("s_", "c_")
        .withColumn("rank", F.when(p > 0, rank).otherwise(F.lit(2.0)))
    )
    held, ranked = base, scratch.keep(ranked)
    scratch.drop(held)
    cut = _rank_cuts(ranked)
    joined = ranked.join(cut, F.col("src").eqNullSafe(F.col("cut_src")), "left")
    extra = F.when((F.col("rank") < F.coalesce("cut", F.lit(0.0))) & (F.col("size") > 0), 1).otherwise(0)
    copies = F.least(F.col("certain") + extra, F.lit(max_copies)).cast("int")
    return joined.select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        F.col("target").cast("double").alias("target"),
        (copies * F.col("size")).cast("bigint").alias("taken"),
        copies.alias("copies"),
        *[F.col(f"key_{i}").alias(c) for i, c in enumerate(keys)],
    )


def _rank_cuts(ranked: DataFrame) -> DataFrame:
    """cut_src, cut: of each source, documents with rank < cut hold about ``due`` words.

    Pass 1 finds the bin of 1/BINS where the words pass ``due``, pass 2 the bin of
    1/BINS**2 in it; of the last bin's two edges the nearer one is taken. Partial sums
    are at most BINS rows of a source and task.
    """
    due = ranked.where("rank < 1").groupBy("src").agg(F.first("due").alias("due"))
    first = _narrow(ranked.where("rank < 1").select("src", F.col("rank").alias("r"), "size"), due.withColumn("lo", F.lit(0.0)).withColumn("below", F.lit(0.0)), 1.0)
    second = _narrow(ranked.where("rank < 1").select("src", F.col("rank").alias("r"), "size"), first.select("src", "due", F.col("start").alias("lo"), "below"), 1.0 / BINS)
    nearer_end = (F.col("below") + F.col("inside") - F.col("due")) <= (F.col("due") - F.col("below"))
    return second.select(F.col("src").alias("cut_src"), F.when(nearer_end, F.col("start") + F.lit(1.0 / BINS / BINS)).otherwise(F.col("start")).alias("cut"))


def _narrow(rows: DataFrame, span: DataFrame, width: float) -> DataFrame:
    """span (src, due, lo, below) narrowed to the one of BINS bins of [lo, lo + width) that holds due."""
    s = span.select(F.col("src").alias("s_"), "due", "lo", "below")
    b = F.floor((F.col("r") - F.col("lo")) / F.lit(width / BINS)).cast("int")
    bins = (
        rows.join(s, F.col("src").eqNullSafe(F.col("s_")))
        .where((F.col("r") >= F.col("lo")) & (F.col("r") < F.col("lo") + F.lit(width)))
        .withColumn("bin", F.least(b, F.lit(BINS - 1)))
        .groupBy("src", "bin", "due", "lo", "below")
        .agg(F.sum("size").alias("inside"))
    )
    before = F.coalesce(F.sum("inside").over(W.partitionBy("src").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + F.col("below")
    bins = bins.withColumn("before", before)
    # the bin that holds due; of rows that end short of it by rounding, the last
    hit = F.struct((F.col("before") + F.col("inside") < F.col("due")).alias("short"), F.when(F.col("before") + F.col("inside") < F.col("due"), -F.col("bin")).otherwise(F.col("bin")), "bin", "before", "inside")
    return (
        bins.groupBy("src", "due", "lo")
        .agg(F.min(hit).alias("h"))
        .select("src", "due", (F.col("lo") + F.col("h.bin") * F.lit(width / BINS)).alias("start"), F.col("h.before").alias("below"), F.col("h.inside").alias("inside"))
    )


def times(docs: DataFrame, **options) -> DataFrame:
    """w1, w2, times: how often the mix takes the rows of ``docs`` that have this digest."""
    w1, w2 = row_digest(docs)
    a, b = free_name(docs, "w1"), free_name(docs, "w2")
    taken = mix(docs.withColumns({a: w1, b: w2}), keys=(a, b), **options)
    return taken.groupBy(F.col(a).alias("w1"), F.col(b).alias("w2")).agg(F.sum("copies").alias("times")).where("times > 0")
