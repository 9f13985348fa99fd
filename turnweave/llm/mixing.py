"""Mixing sources to target weights by entropy balancing.

Every document i of size w_i words gets a rate r_i >= 0, the expected number of its copies.
Among all rates with sum(w_i r_i) = T_s for each source s and r_i <= cap, those nearest to
"every document once" in relative entropy are

    r_i = min(cap, exp(lambda_s * w_i / m_s)),    m_s: the source's mean size,

where the multipliers lambda maximise a concave dual whose gradient is the shortfall of
each source and whose Hessian is diagonal, as a document has one source.  Newton steps,
kept inside a bracket, solve it: each is one distributed aggregation over the (source,
size) histogram, which has all that rates depend on.  No step brings rows to the driver.

Rates become copies by a dithered floor, floor(r_i + h_i) with h_i a hash of the row in
[0, 1): expected copies are r_i, none exceeds cap.  ``DITHERS`` shifts of the hash are
tried in the same aggregation, and each source takes the shift whose words come nearest to
its target.  Everything is DataFrame functions; results depend on the rows' content alone,
so reruns agree.

Nulls and edges: a null text has size 0 and a null source is a source of its own, last in
order.  Documents of size 0 have rate 1 and add no words.  Repeated rows with equal id and
text get equal copies.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import any_columns, materialize, read, spill

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3
DITHERS = 64
MAX_STEPS = 60
TOLERANCE = 1e-9


def word_count(text: str) -> Column:
    """Runs of bytes outside [\\x20\\x09-\\x0D]."""
    t = F.coalesce(F.col(text), F.lit(""))
    return F.regexp_count(t, F.lit(WORDS)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, source_size, target`` of each source of ``sizes(source, source_size)``.

    Weights repeat over the sources by code point, null last.  A target stops at ``cap``
    times its source's size; the excess goes to the others by weight until none is above.
    That fixed point is target = min(cap * size, weight * level) with one common level,
    found here at once: in order of cap * size / weight the stopped sources come first.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    ranked = sizes.withColumn("k", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("k") % len(weights) + 1).cast("int")).cast("double"))
    ranked = ranked.withColumn("full", F.lit(float(cap)) * F.col("source_size"))
    run = Window.orderBy(F.col("full") / F.col("weight"), "k").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    ranked = (
        ranked.withColumn("full_before", F.coalesce(F.sum("full").over(run), F.lit(0.0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(run), F.lit(0.0)))
        .withColumn("total", F.sum("source_size").over(whole).cast("double"))
        .withColumn("weights", F.sum("weight").over(whole))
    )
    # the level if exactly the sources before this one are stopped; the first that stays below its own stop fixes it
    ranked = ranked.withColumn("level", (F.col("total") - F.col("full_before")) / (F.col("weights") - F.col("weight_before")))
    free = ranked.withColumn("free", F.col("weight") * F.col("level") <= F.col("full"))
    level = F.min(F.when(F.col("free"), F.struct(F.col("full") / F.col("weight"), "k", "level"))).over(whole)
    out = free.withColumn("at", level["level"])
    return out.select("source", "source_size", F.when(F.col("source_size") == 0, 0.0).otherwise(F.least("full", F.coalesce(F.col("weight") * F.col("at"), F.col("full")))).alias("target"))


def _rate(multiplier: Column, size: Column, mean: Column, cap: int) -> Column:
    return F.when(size == 0, 1.0).otherwise(F.least(F.lit(float(cap)), F.exp(F.least(F.lit(50.0), multiplier * size / mean))))


def solve_rates(histogram: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """``source, source_size, target, mean, multiplier`` by safeguarded Newton steps on
    ``histogram(source, size, n)``."""
    stats = histogram.where("size > 0").groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), F.max("size").alias("largest"), F.min("size").alias("smallest"))
    state = targets.alias("t").join(stats.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source")), "left").select("t.*", F.coalesce("mean", F.lit(1.0)).alias("mean"), "largest", "smallest")
    # every rate reaches cap at the upper end; at the lower one, words taken are below any target left to seek
    state = state.select(
        "source", "source_size", "target", "mean",
        F.lit(0.0).alias("multiplier"),
        (F.lit(-700.0) * F.col("mean") / F.coalesce("smallest", F.lit(1))).alias("low"),
        (F.lit(1.0001) * F.log(F.lit(float(cap))) * F.col("mean") / F.coalesce("smallest", F.lit(1))).alias("high"),
        F.lit(False).alias("done"),
    )
    state = spill(state, "mix-state")  # a table with its true size, as estimates of nested joins multiply
    for _ in range(MAX_STEPS):
        h = F.broadcast(state.withColumnRenamed("source", "s"))  # one row per source: bounded by their number, checked by the caller
        joined = histogram.join(h, F.col("source").eqNullSafe(F.col("s")))
        rate = _rate(F.col("multiplier"), F.col("size"), F.col("mean"), cap)
        words = F.col("size") * F.col("n") * rate
        slope = F.when(rate < cap, words * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = joined.groupBy("source").agg(F.sum(words).alias("words"), F.sum(slope).alias("slope"))
        nxt = state.alias("a").join(sums.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")), "left").select("a.*", "words", "slope")
        gap = F.col("words") - F.col("target")
        done = F.col("done") | F.col("words").isNull() | (F.abs(gap) <= TOLERANCE * F.greatest(F.col("target"), F.lit(1.0))) | (F.col("high") - F.col("low") < 1e-12)
        nxt = nxt.withColumn("low", F.when(gap < 0, F.col("multiplier")).otherwise(F.col("low"))).withColumn("high", F.when(gap > 0, F.col("multiplier")).otherwise(F.col("high")))
        step = F.col("multiplier") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (step > F.col("low")) & (step < F.col("high"))
        nxt = nxt.withColumn("done", done).withColumn("multiplier", F.when(F.col("done"), F.col("multiplier")).when(inside, step).otherwise((F.col("low") + F.col("high")) / 2))
        state = spill(nxt.select("source", "source_size", "target", "mean", "multiplier", "low", "high", "done"), "mix-state")
        if not state.where("not done").limit(1).count():
            break
    return state.select("source", "source_size", "target", "mean", "multiplier")


def _unit(key: Column, shift: Column | float) -> Column:
    """The hash of a row in [0, 1), moved around the circle by ``shift``."""
    h = F.pmod(key, F.lit(1 << 30)).cast("double") / float(1 << 30) + shift
    return h - F.floor(h)


def entropy_mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, max_sources: int = 100_000, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: ``id, source, size, source_size, target, rate, copies,
    taken`` and the columns named in ``keep``.

    ``max_sources`` bounds what is broadcast (one row per source, some 100 bytes); more
    sources are an error, not a silent change of plan.
    """
    size = word_count(text_col)
    key = F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    rows = spill(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), key.alias("key"), *keep), "mix-sizes")
    histogram = materialize(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    sizes = materialize(histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    if sizes.count() > max_sources:
        raise ValueError(f"over {max_sources} sources")
    solved = solve_rates(histogram, source_targets(sizes, weights, cap), cap)

    s = F.broadcast(solved.withColumnRenamed("source", "s"))
    rated = rows.join(s, F.col("source").eqNullSafe(F.col("s"))).withColumn("rate", _rate(F.col("multiplier"), F.col("size"), F.col("mean"), cap))
    tried = [F.sum(F.col("size") * F.floor(F.col("rate") + _unit(F.col("key"), j / DITHERS))).alias(f"w{j}") for j in range(DITHERS)]
    sums = rated.groupBy("source").agg(F.first("target").alias("aim"), *tried)
    near = F.array_min(F.array(*(F.struct(F.abs(F.col(f"w{j}") - F.col("aim")).alias("miss"), F.lit(j).alias("j")) for j in range(DITHERS))))
    shift = materialize(sums.select(F.col("source").alias("s2"), (near["j"] / DITHERS).alias("shift")))
    out = rated.join(F.broadcast(shift), F.col("source").eqNullSafe(F.col("s2")))
    out = out.withColumn("copies", F.least(F.lit(cap), F.floor(F.col("rate") + _unit(F.col("key"), F.col("shift"))).cast("long")).cast("long"))
    return out.select("id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"), *keep)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = entropy_mix(read(spark, sf_dir, "documents"))
    return mix.select(F.col("id").alias("doc_id"), "size", "source_size", F.col("target").cast("double").alias("target"), "taken", "rate", "copies")


@any_columns
def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, each as often as the mix takes it, with their own columns.  Rows without an id, source or
    text take part as rows of their own; an empty table gives none."""
    mix = entropy_mix(docs.withColumn("_whole", F.struct(*docs.columns)), keep=("_whole",))
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return mix.where("copies > 0").select("_whole.*", copies.alias("_copy")).drop("_copy").select(*docs.columns)
