"""Connected components of a link table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.llm.common import written
from penprint.operators.scale import lookup_join


PART = 250_000  # links of a partition


def _least(edges: DataFrame, key: str, value: str, parts: int) -> DataFrame:
    return written(edges.groupBy(F.col(key).alias("k")).agg(F.min(value).alias("m")).coalesce(parts), "least")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.col("b").cast("decimal(38,0)")).alias("s")).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The smallest id that each linked id reaches: id, component. Ids without a link have no row.

    Rounds of large and small stars: every id hands its larger neighbours, then its smaller ones, to the smallest id
    it sees, until the links are stars around the smallest ids. A round only takes a minimum per id, combined before
    the shuffle, and joins it back, salted or broadcast by size, so an id with most of the links is not gathered in one
    task. The number of rounds grows with the logarithm of the longest chain. Null ends and loops are left out. Tables
    keep one partition for each ``PART`` links, so that few links are not spread over many tasks.
    """
    parts = max(8, -(-links.count() // PART))
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    edges = written(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().coalesce(parts), "links")
    before = None
    while (now := _state(edges)) != before and now[0]:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both, "a", "b", parts)
        seen = lookup_join(both.select(F.col("a").alias("k"), "b"), least, ["k"], salt_on=["b"])
        large = seen.where(F.col("b") > F.col("k")).select(F.col("b").alias("a"), F.least("k", "m").alias("b"))
        large = written(large.distinct().coalesce(parts), "large")
        least = _least(large, "a", "b", parts)
        seen = lookup_join(large.select(F.col("a").alias("k"), "b"), least, ["k"], salt_on=["b"])
        ends = F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("k").alias("a"), F.col("m").alias("b"))))
        edges = written(seen.select(ends.alias("e")).select("e.a", "e.b").where("a <> b").distinct().coalesce(parts), "small")
    roots = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return roots.unionByName(roots.select(F.col("component").alias("id"), "component").distinct())
