"""Connected components of links between ids, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.stored import release, store


def _sorted_pairs(pairs: DataFrame) -> DataFrame:
    """(a, b) with a > b, each once."""
    return pairs.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) of the ids in `links` (a, b); the component is its lowest id.

    Each step connects neighbours to the lowest one known. Neighbourhoods are reduced to
    their minimum in the map tasks and joined back, so an id with very many links is not
    collected; each step is written, so none runs again for the next."""
    pairs = store(_sorted_pairs(links))
    before = None
    while (state := _state(pairs)) != before:
        before = state
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        larger = both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = _sorted_pairs(larger)
        lowest = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        done, pairs = pairs, store(_sorted_pairs(smaller.unionByName(lowest.select("a", F.col("m").alias("b")))))
        release(done)
    own = pairs.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(own)
