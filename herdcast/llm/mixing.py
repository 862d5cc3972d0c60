"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source's rate is its target share of the characters over its own: the mean number of times
each of its documents should appear. Every document draws its count by inverting the Poisson
distribution at a number hashed from its id, is exploded by that count, and the copies go
into one global random order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdcast.llm.common import let, materialise, numbered

#: Rates above this are drawn as a sum of independent parts, which keeps the tables short.
PART = 16.0


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5,
                 epochs: float = 1.0) -> DataFrame:
    """Per source: documents, characters, rate, parts, and the distribution of one part.

    Without ``weights`` the target share of a source is its share of the characters to the power
    ``temperature``, normalised. With them, a source that is not named gets none. ``epochs`` is
    the size of the mix as a multiple of the corpus. A null source is a source of its own; one
    without any character has rate 0. Expects columns source and text.
    """
    sums = materialise(docs.groupBy("source").agg(
        F.count("*").alias("n_docs"), F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("long").alias("n_chars")), "mix-sources")
    share = F.pow(F.col("n_chars").cast("double"), F.lit(temperature))
    if weights is not None:
        share = F.lit(0.0)
        for name, weight in weights.items():
            share = F.when(F.col("source") == name, F.lit(float(weight))).otherwise(share)
    share = F.when(F.col("n_chars") > 0, share).otherwise(F.lit(0.0))
    total = sums.agg(F.sum("n_chars").alias("chars"), F.sum(share).alias("share")).first()
    all_chars, all_share = float(total["chars"] or 0), float(total["share"] or 0)
    rate = F.when((F.col("n_chars") > 0) & F.lit(all_share > 0),
                  F.lit(epochs * all_chars) * (share / F.lit(all_share or 1.0)) / F.col("n_chars")).otherwise(F.lit(0.0))
    rated = sums.withColumn("rate", rate).withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int"))
    return materialise(rated.withColumn("cdf", _distribution(F.col("rate") / F.col("parts"))), "mix-rates")


def _distribution(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... until the rest is below the spacing of doubles."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))
    return F.aggregate(
        F.sequence(F.lit(1), last), start,
        lambda a, k: F.struct((a["p"] * mean / k).alias("p"),
                              F.concat(a["cdf"], F.array(F.element_at(a["cdf"], -1) + a["p"] * mean / k)).alias("cdf")),
        lambda a: a["cdf"])


def _uniform(seed: int, part: Column, key: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of a hash."""
    text = F.concat_ws(":", F.lit(str(seed)), part.cast("string"), F.coalesce(key.cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(2 ** 52)

def _below(cdf: Column, u: Column) -> Column:
    """How many entries of a distribution are below ``u``: the smallest k with P(X <= k) >= u."""
    return let(u, lambda x: F.size(F.filter(cdf, lambda c: c < x)))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5,
                epochs: float = 1.0, seed: int = 20) -> DataFrame:
    """The mix: columns of ``docs``, then ``copy_`` (from 1) and ``order_key_``, in global random order.

    Needs doc_id, text and source. Repeated rows of one doc_id get the same count; a null id is
    hashed as an empty one; null and empty texts count no characters but are drawn like their
    source; an empty table gives an empty one. Other columns pass through under their names.
    """
    at = {n: f"_{docs.columns.index(n)}" for n in ("doc_id", "text", "source")}
    own = numbered(docs)
    rates = source_rates(own.select(F.col(at["source"]).alias("source"), F.col(at["text"]).alias("text")),
                         weights, temperature, epochs).select(F.col("source").alias("of_"), "parts", "cdf")
    key = F.col(at["doc_id"])
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col("parts")), F.lit(0),
        lambda a, j: a + _below(F.col("cdf"), _uniform(seed, j, key)))
    counted = own.join(rates, own[at["source"]].eqNullSafe(rates["of_"])).withColumn("n_", drawn).where("n_ > 0")
    copies = counted.select(*own.columns, F.explode(F.sequence(F.lit(1), F.col("n_"))).alias("copy_"))
    order = F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), F.coalesce(key.cast("string"), F.lit("")),
                              F.col("copy_").cast("string")).cast("binary"))
    return (copies.withColumn("order_key_", order).withColumn("tie_", F.rand(seed))
            .orderBy("order_key_", "tie_").drop("tie_")
            .toDF(*docs.columns, "copy_", "order_key_"))
