"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words; its documents are each expected to be taken
target / size of the source times. Documents are put in strata of like size. From the largest
sizes down, a stratum gets its share of the copies that are still to be given, rounded at
random: up as often as the fraction says. So every document can be taken and left, with the
same expectation, and what one stratum is over or under by is spread over all smaller
documents. The words taken come near the target although a few documents may hold much of a
source. A stratum's copies are given evenly; those left over go to the documents with the
smallest ratio of random odds to inclusion odds.

The documents of a stratum have one chance, so the ratio orders them as the random number
does: within a stratum this is simple random sampling, the equal-chance case of Pareto order
sampling.

The documents of a stratum are never ranked in one task: the rank's threshold is found in
two histograms of the ratio, and only the documents of one fine bin are ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from longreg.sources.tables import stage

from .common import WORD, packed

BINS = 4096
#: Strata per doubling of the size.
STRATA = 8


def source_targets(sources: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """Adds target to (source, source_size), one row per source.

    Sources by code point, null last, weigh `weights` in turn. Targets share the total size
    by weight; none exceeds `cap` times its source's size, and the excess is shared among the
    others by weight. With t the common words per unit of weight, a source's target is
    min(t * weight, cap * size): sources reach their cap in the order of size / weight, so
    the right t follows from running sums in that order.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    weighed = sources.withColumn("_w", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1))
    rising = Window.orderBy(F.col("source_size") / F.col("_w"), F.col("source").isNull(), "source")
    before, everything = rising.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    total = F.sum("source_size").over(everything)
    free_w = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    left = total - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    capped = weighed.withColumn("_t", left / free_w).withColumn(
        "_capped", F.col("_t") * F.col("_w") > cap * F.col("source_size"))
    # The share is that of the first source in this order which stays below its cap.
    share = F.min(F.when(~F.col("_capped"), F.struct(F.col("source_size") / F.col("_w"), F.col("_t")))).over(everything)
    target = F.least(share["_t"] * F.col("_w"), cap * F.col("source_size"))
    return capped.withColumn("target", F.coalesce(target, cap * F.col("source_size")).cast("double")).drop(
        "_w", "_t", "_capped")


def stratum(size: Column) -> Column:
    return F.when(size > 0, F.floor(F.log2(size) * STRATA)).otherwise(-1).cast("int")


def _draws(strata: DataFrame, cap: float) -> DataFrame:
    """(source, stratum, n, sure, draws): each of the n documents gets sure copies, draws of them one more.

    `strata` has n, words, least, the smallest of its documents' random numbers (53 bits), and
    the source's source_size and target. Copies are rounded up if a number drawn from the
    smallest random number says so: a document alone is taken if its own number is below its
    chance. No document gets more than cap copies. The wanted copies of a document stay the
    same on average from stratum to stratum, as rounding is even.
    """
    rows = F.sort_array(F.collect_list(F.struct("stratum", "n", "words", "least")), asc=False)
    start = F.struct(F.coalesce("target", F.lit(0.0)).alias("target"), F.col("source_size").cast("double").alias("words"),
                     F.array().cast("array<struct<stratum:int,n:long,sure:long,draws:long>>").alias("out"))

    def step(state, row):
        rate = F.least(F.greatest(state["target"] / state["words"], F.lit(0.0)), F.lit(float(cap)))
        up = F.pow(1 - (row["least"] + 0.5) / float(1 << 53), row["n"])  # the least of n is evenly spread in this
        copies = F.least(F.floor(rate * row["n"] + up), F.floor(float(cap) * row["n"])).cast("long")
        # Copies of documents without words add nothing; none is drawn.
        even = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
        copies = F.when(row["words"] > 0, copies).otherwise(even * row["n"])
        sure = F.floor(copies / row["n"]).cast("long")
        return F.struct((state["target"] - copies * (row["words"] / row["n"])).alias("target"), (state["words"] - row["words"]).alias("words"),
                        F.concat(state["out"], F.array(F.struct(row["stratum"].alias("stratum"), row["n"].alias("n"), sure.alias("sure"),
                                                                (copies - sure * row["n"]).alias("draws")))).alias("out"))

    return (strata.groupBy("source", "source_size", "target").agg(rows.alias("rows"))
            .withColumn("rows", F.aggregate("rows", start, step)["out"])
            .select("source", F.explode("rows").alias("r")).select("source", "r.*"))


def _rank_within(counts: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Adds before, the rows of the key in smaller bins, to counts by bin (at most BINS a key)."""
    w = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("rows").over(w), F.lit(0)))


def mix_documents(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: float = 3.0, seed: int = 7) -> DataFrame:
    """How often the mix takes each document: (doc_id, source, size, source_size, target, copies).

    Random numbers are hashes of doc_id and seed, so reruns agree. Null texts have size 0;
    documents without words are taken as often as is certain, which adds nothing. Null
    sources are one source, null ids are sampled like others, rows with equal ids are ranked
    one by one. A whole number `cap` bounds every document's copies. Empty in, empty out.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    u = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11)  # 53 random bits
    base = stage(docs.select("doc_id", "source", size.alias("size"), u.alias("_u"))
                 .withColumn("stratum", stratum(F.col("size"))), "mix-sizes")
    strata = base.groupBy("source", "stratum").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"), F.min("_u").alias("least"))
    sources = source_targets(strata.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap)
    sources = stage(sources.withColumnRenamed("source", "_s"), "mix-targets")
    own = F.col("source").eqNullSafe(F.col("_s"))
    draws = stage(_draws(strata.join(sources, own).drop("_s"), cap).join(sources, own).drop("_s"), "mix-draws")

    # One row per source and stratum, of which there are at most STRATA * 64 a source.
    plan = draws.select(F.col("source").alias("_s"), F.col("stratum").alias("_k"), "n", "draws", "sure", "source_size", "target")
    here = F.col("source").eqNullSafe(F.col("_s")) & (F.col("stratum") == F.col("_k"))
    chance = F.col("draws") / F.col("n")
    random = (F.col("_u") + 0.5) / float(1 << 53)
    ratio = (random / (1 - random)) / (chance / (1 - chance))
    # Within a stratum the ratio rises with the random number, so its bins are bins of the ratio.
    rows = base.join(plan, here).drop("_s", "_k").withColumns({
        "_q": F.when((F.col("draws") > 0) & (F.col("draws") < F.col("n")), ratio),
        "_b1": F.shiftrightunsigned("_u", 41).cast("int"), "_b2": (F.shiftrightunsigned("_u", 29) % BINS).cast("int")})
    key = ["source", "stratum"]
    drawn = rows.where(F.col("_q").isNotNull())
    first = _rank_within(drawn.groupBy(*key, "draws", "_b1").agg(F.count(F.lit(1)).alias("rows")), key, "_b1")
    # A row per source and stratum at most. They are stored, else each later step would make all earlier ones anew.
    edge1 = stage(first.where((F.col("before") < F.col("draws")) & (F.col("before") + F.col("rows") >= F.col("draws"))).select(
        F.col("source").alias("_s"), F.col("stratum").alias("_k"), F.col("_b1").alias("_e1"), F.col("before").alias("_n1")), "mix-edges")
    rows = rows.join(edge1, here, "left").drop("_s", "_k")
    inside1 = rows.where(F.col("_b1") == F.col("_e1"))
    second = _rank_within(inside1.groupBy(*key, "draws", "_n1", "_b2").agg(F.count(F.lit(1)).alias("rows")), key, "_b2")
    need = F.col("draws") - F.col("_n1")
    edge2 = stage(second.where((F.col("before") < need) & (F.col("before") + F.col("rows") >= need)).select(
        F.col("source").alias("_s"), F.col("stratum").alias("_k"), F.col("_b2").alias("_e2"), F.col("before").alias("_n2")), "mix-fine-edges")
    rows = rows.join(edge2, here, "left").drop("_s", "_k")
    fine = (F.col("_b1") == F.col("_e1")) & (F.col("_b2") == F.col("_e2"))
    keep = ["doc_id", "source", "size", "source_size", "target", "sure"]
    below = (F.col("_b1") < F.col("_e1")) | ((F.col("_b1") == F.col("_e1")) & (F.col("_b2") < F.col("_e2")))
    decided = rows.where(F.col("_q").isNull() | ~fine).select(*keep, F.when(
        F.col("_q").isNull(), (F.col("draws") > 0) & (F.col("draws") >= F.col("n"))).otherwise(below).cast("int").alias("_more"))
    rank = F.row_number().over(Window.partitionBy("source", "stratum").orderBy("_q", "doc_id"))
    edge = rows.where(F.col("_q").isNotNull() & fine).select(
        *keep, (rank <= F.col("draws") - F.col("_n1") - F.col("_n2")).cast("int").alias("_more"))
    return decided.unionByName(edge).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("sure") + F.col("_more")).cast("int").alias("copies"))


def apply_mix(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """The documents of the mix, each row repeated as often as it is taken, with the columns of
    `docs`. Equal ids share the copies of all their rows evenly, the first rows getting what is over."""
    keys = ["doc_id", "source"]
    taken = stage(mix.groupBy(*keys).agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")).select(
        F.col("doc_id").alias("_d"), F.col("source").alias("_s"), "_copies", "_rows").where("_copies > 0"), "mix-taken")
    joined = packed(docs, "doc_id", "source").join(taken, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s")))
    single = joined.where("_rows = 1").withColumn("_n", F.col("_copies"))
    # By content, so that reruns agree; rows of equal content are interchangeable.
    rank = F.row_number().over(Window.partitionBy("_d", "_s").orderBy(F.sha2(F.to_json("_row"), 256))) - 1
    several = joined.where("_rows > 1").withColumn("_n", F.floor(F.col("_copies") / F.col("_rows")) + (
        rank < F.col("_copies") % F.col("_rows")).cast("int"))
    return (single.unionByName(several).where("_n > 0")
            .withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select("_row.*"))
