"""Mixing sources to target weights: capped water-filling and seeded sampling.

1. Sizes: words per document, summed per source (one small row per source).
2. Targets: the level L with sum(min(cap_s, L * weight_s)) = budget, where
   cap_s = max_epochs * size_s.  Clamping every source above its cap and
   sharing the excess by weight until none is above ends at this level; sorted
   by cap / weight it is one running sum over the source table.
3. Repetitions: ``floor(target / size)`` whole passes over a source, and a
   seeded sample of its documents for the fraction.  Documents are ordered by a
   hash; the sample is the prefix whose words come nearest to the fraction.
   The prefix is found by two levels of sums (hash buckets, then rows of the
   one bucket in which a source's prefix ends), so that a source with a third
   of all rows never meets in one task.  What a row needs to know is one key per
   source, so the corpus itself is not sorted.

Nulls and edge cases: a null text has size 0 and is taken 0 times over; a null
source is a source of its own, last in the order of weights; documents of size
0 have taken 0; an empty table gives an empty result.  Repeated rows each count;
equal ones are sampled together.  Reruns agree: the order is a hash of the id,
then the id, size and text hash.  Input columns of other names are carried by
``mix`` and ignored by ``plan_mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import cut, n_words

#: Weights given to the sources in order, repeating.
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 20240131


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, weight, target): one row per source."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(x) for x in weights])
    per = per.select("source", "source_size", w[F.pmod(
        F.row_number().over(everything) - 1, F.lit(len(weights))).cast("int")].cast("double").alias("weight"))
    cap = (F.lit(float(max_epochs)) * F.col("source_size"))
    per = per.withColumn("cap", cap)
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(after))
    per = per.withColumn("level", level)
    # the first source whose cap is not below its level fixes the level of all after it
    fits = F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level"))
    per = per.withColumn("fixed", F.first(fits, ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, 0)))
    return per.select("source", "source_size", "weight",
                      F.when(F.col("fixed").isNull(), F.col("cap"))
                      .otherwise(F.least("cap", F.col("fixed") * F.col("weight"))).alias("target"))


def _key(seed: int) -> Column:
    """Sampling order of a row: hash of the id (63 bits), then id, size and text hash."""
    return F.struct(F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 1).alias("h"),
                    F.col("doc_id").alias("id"), F.col("size").alias("size"), F.col("_tie").alias("tie"))


_BUCKET_BITS = 12  #: first level of sums: 4,096 hash buckets a source


def _sized(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str,
           carry: bool = False) -> DataFrame:
    out = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        n_words(F.col(text_col)).alias("size"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_tie"),
        *([F.struct(*[docs[c] for c in docs.columns]).alias("_row")] if carry else []))
    return out.withColumn("_key", _key(seed))


def _cuts(sized: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """Per source: size, target, whole passes, and the last key of the sampled prefix."""
    shift = 63 - _BUCKET_BITS
    bucket = F.shiftright(F.col("_key.h"), shift)
    sums = sized.groupBy("source", bucket.alias("b")).agg(F.sum("size").alias("bsize"))
    t = targets(sums.select("source", F.col("bsize").alias("size")), weights, max_epochs)
    t = t.select(
        F.col("source").alias("t_source"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.least(F.lit(float(max_epochs)), F.floor(
            F.col("target") / F.col("source_size")))).otherwise(0).cast("long").alias("whole"))
    t = t.withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
    upto = Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("upto", F.sum("bsize").over(upto))
    # the bucket in which the prefix ends: the first whose running sum exceeds the rest
    edge = sums.join(t, sums["source"].eqNullSafe(t["t_source"])).where("upto > rest").groupBy(
        "source", "rest").agg(F.min("b").alias("edge"), F.min_by(F.col("upto") - F.col("bsize"), "b").alias("before"))
    edge = edge.select(F.col("source").alias("e_source"), F.col("rest").alias("e_rest"), "edge", "before")
    near = sized.select("source", "size", "_key").join(
        edge, F.col("source").eqNullSafe(F.col("e_source")) & (bucket == F.col("edge")))
    near = near.groupBy("source", "_key", "before", "e_rest").agg(F.sum("size").alias("group_size"))
    inside = Window.partitionBy("source").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumn("at", F.col("before") + F.coalesce(F.sum("group_size").over(inside), F.lit(0)))
    last = near.where("at + group_size / 2 <= e_rest").groupBy(F.col("source").alias("l_source")).agg(
        F.max("_key").alias("last"))
    top = F.lit(2**63 - 1)
    none = F.struct((F.shiftleft(F.col("edge"), shift) - 1).alias("h"), top.alias("id"),
                    top.alias("size"), top.alias("tie"))
    per = t.join(edge, t["t_source"].eqNullSafe(edge["e_source"]), "left")
    per = per.join(last, per["t_source"].eqNullSafe(last["l_source"]), "left")
    return per.select("t_source", "source_size", "target", "whole",
                      F.coalesce("last", F.when(F.col("edge").isNotNull(), none)).alias("last"))


#: Sources whose table is broadcast, at most (some 100 bytes a row).
FEW_SOURCES = 10_000
#: Parts that each source's rows are dealt to where the table is larger.
SALTS = 64


def _planned(sized: DataFrame, cuts: DataFrame, max_epochs: int) -> DataFrame:
    """Rows with their number of copies; rows and texts of a source do not meet in one task."""
    cuts = cut(cuts)
    same = sized["source"].eqNullSafe(cuts["t_source"])
    if cuts.count() <= FEW_SOURCES:
        rows = sized.join(F.broadcast(cuts), same)
    else:
        salted = cuts.withColumn("t_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = sized.join(salted, same & (F.pmod(F.col("_key.h"), F.lit(SALTS)) == F.col("t_salt"))).drop("t_salt")
    # no edge bucket: the rest takes the whole source
    extra = F.when(F.col("last").isNull(), F.lit(1)).otherwise((F.col("_key") <= F.col("last")).cast("int"))
    copies = F.when(F.col("size") > 0, F.least(F.col("whole") + extra, F.lit(max_epochs))).otherwise(F.lit(0))
    return rows.withColumn("copies", copies.cast("long"))


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
             seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) per input row."""
    sized = cut(_sized(docs, seed, id_col, text_col, source_col))  # texts are read once
    return _planned(sized, _cuts(sized, weights, max_epochs), max_epochs).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it, same columns."""
    small = cut(_sized(docs, seed, id_col, text_col, source_col))
    rows = _planned(_sized(docs, seed, id_col, text_col, source_col, carry=True),
                    _cuts(small, weights, max_epochs), max_epochs)
    rows = rows.where("copies > 0").select(
        "_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
    return rows.select("_row.*")
