"""Distribution helpers shared by the operators.

Each one keeps results exact when a single key holds a large part of the rows:
joins are broadcast only after their size was counted, ranks and quantiles work
on counts per bin first, and running totals on range-partitioned shards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from penprint.session import checkpoint_root, run_folder

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 256 << 20
FREQUENT_ROWS = 1 << 18
SALTS = 32


def balanced(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a table that arrives in fewer splits than there are cores.

    A large table already has more splits than cores and passes unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def unnest(
    df: DataFrame, keep: Sequence[str], array: Column, value: str, pos: str | None = None
) -> DataFrame:
    """One row per non-null array element: the kept columns, [pos,] value.

    The outer form matters: the plain one makes Spark test the array's size below
    the shuffle, which computes a long tokeniser twice.
    """
    spread = F.posexplode_outer(array).alias(pos, value) if pos else F.explode_outer(array).alias(value)
    return df.select(*keep, spread).where(F.col(value).isNotNull())


def settled(df: DataFrame) -> DataFrame:
    """Write a derived table once to the checkpoint folder and read it from there."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a derived table once below the checkpoint folder as Parquet and read it from there.

    Column by column it takes a fraction of the disk that ``settled`` does, but has no place for vectors' metadata.
    """
    path = run_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """Count a table's rows and bytes, up to the limits, before it is broadcast."""
    limit = BROADCAST_ROWS if max_rows is None else max_rows
    width = F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, ST.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (ST.ArrayType, ST.MapType)):
            width = width + 32 * F.greatest(F.size(field.name), F.lit(0))
        else:
            width = width + 8
    seen = df.limit(limit + 1).agg(F.count("*").alias("n"), F.sum(width.cast("bigint")).alias("b")).first()
    return seen["n"] <= limit and (seen["b"] or 0) <= BROADCAST_BYTES


def lookup_join(
    big: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    salt_on: Sequence[str] | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Join rows to a lookup table whose keys are unique.

    The table is broadcast when a count shows it is small. Otherwise the rows of
    a hot key are spread over ``SALTS`` partitions and the table is repeated per
    salt, so neither side needs to fit in one task.
    """
    on = list(on)
    if fits_broadcast(table, max_rows):
        return big.join(F.broadcast(table), on, how)
    plain = [f.name for f in big.schema.fields if not isinstance(f.dataType, (ST.MapType, ST.UserDefinedType))]
    salted = F.pmod(F.xxhash64(*(salt_on or plain)), F.lit(SALTS)).cast("int")
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.withColumn("_salt", salted).join(repeated, [*on, "_salt"], how).drop("_salt")


def frequent_keys(rows: DataFrame, key: str, max_rows: int | None = None) -> DataFrame:
    """The keys that make most rows, at most ``max_rows``: (key)."""
    return most_counted(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")), key, "n", max_rows)


def most_counted(counts: DataFrame, key: str, n: str, max_rows: int | None = None) -> DataFrame:
    """The keys of the largest counts, at most ``max_rows``: (key), from one row per key.

    Keys are banded by the power of two of their count; only the sizes of the bands come to the driver. The keys left out
    have about as many rows as the rarest one kept, or fewer, so none of them is hot.
    """
    limit = FREQUENT_ROWS if max_rows is None else max_rows
    counts = stored(counts.select(key, F.floor(F.log2(n)).cast("int").alias("_band")), "frequent")
    sizes = counts.groupBy("_band").agg(F.count("*").alias("n"), F.sum(F.octet_length(F.col(key).cast("string"))).alias("b"))
    lowest, n_kept, b = 64, 0, 0
    for band in sorted(sizes.collect(), key=lambda r: -r["_band"]):
        n_kept, b = n_kept + band["n"], b + band["b"]
        if n_kept > limit or b > BROADCAST_BYTES // 8:
            break
        lowest = band["_band"]
    return counts.where(F.col("_band") >= lowest).select(key)


def common_part(rows: DataFrame, table: DataFrame, key: str, max_rows: int | None = None) -> DataFrame:
    """The frequent keys of ``rows`` with their columns of a lookup table (nulls where it has none) and ``_common``, true."""
    common = frequent_keys(rows, key, max_rows).withColumn("_common", F.lit(True))
    return stored(common.join(table, key, "left"), "common")


def rare_rows(rows: DataFrame, near: DataFrame, key: str) -> DataFrame:
    """The rows whose key is neither null nor among the frequent ones of ``common_part``."""
    marked = rows.join(F.broadcast(near.select(key, "_common")), key, "left")
    return marked.where(F.col("_common").isNull() & F.col(key).isNotNull()).drop("_common")


def word_join(big: DataFrame, table: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Left join of word rows to a lookup table whose keys are unique.

    A table that a count allows is broadcast. Otherwise the frequent words are looked up in place in a broadcast part of
    the table, and only the rows of the other words, a few in a hundred of a text, are shuffled to the rest of it. ``by``
    names the columns by which ``big`` is partitioned; those rows are brought back to them, so that the words of a key
    meet again without a shuffle of all rows.
    """
    if fits_broadcast(table):
        return big.join(F.broadcast(table), key, "left")
    near = common_part(big, table, key)
    marked = big.join(F.broadcast(near), key, "left")
    here = marked.where(F.col("_common").isNotNull() | F.col(key).isNull()).drop("_common")
    found = rare_rows(big, near, key).join(table, key, "left").select(here.columns)
    return here.unionByName(found.repartition(*by) if by else found)


def hash_order(identity: Column | str, seed: int = 42) -> Column:
    """A shuffled order that does not depend on partitioning: md5 of id and seed."""
    column = F.col(identity) if isinstance(identity, str) else identity
    return F.md5(F.concat(column.cast("string"), F.lit(f":{seed}")))


def hash_cutoffs(
    df: DataFrame, keys: Sequence[str], order: str, ranks: Column, digits: int = 3
) -> DataFrame:
    """Hash value at the given 1-based ranks of every group.

    ``ranks`` is an array built from ``n`` (rows of the group) and ``n_min``
    (rows of the smallest group). Counting per hash prefix finds the bin holding
    a rank, so only one bin per group and rank is sorted (1/4096 of the group).
    Returns keys, slot, cutoff; ranks of zero have no row.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(order).alias("_h"), F.substring(order, 1, digits).alias("_bin"))
    bins = rows.groupBy(*keys, "_bin").agg(F.count("*").alias("_c"))
    within = Window.partitionBy(*keys).orderBy("_bin")
    bins = bins.withColumn("_upto", F.sum("_c").over(within))
    totals = bins.groupBy(*keys).agg(F.sum("_c").alias("n"))
    totals = totals.withColumn("n_min", F.min("n").over(Window.partitionBy(F.lit(0))))
    wanted = totals.select(*keys, F.posexplode(ranks).alias("slot", "_rank"))
    chosen = (
        bins.join(wanted, keys)
        .where((F.col("_rank") > F.col("_upto") - F.col("_c")) & (F.col("_rank") <= F.col("_upto")))
        .select(*keys, "_bin", "slot", (F.col("_rank") - F.col("_upto") + F.col("_c")).alias("_at"))
    )
    inside = Window.partitionBy(*keys, "_bin", "slot").orderBy("_h")
    return (
        lookup_join(rows, settled(chosen), [*keys, "_bin"], salt_on=["_h"])
        .withColumn("_rn", F.row_number().over(inside))
        .where(F.col("_rn") == F.col("_at"))
        .select(*keys, "slot", F.col("_h").alias("cutoff"))
    )


def size_then_hash_rank(groups: DataFrame, keys: Sequence[str], size: str, order: str) -> DataFrame:
    """1-based rank of every row within its keys, by size descending, then hash.

    Ranks are added up from counts per size, then per hash prefix, then inside
    one prefix, so a key with most of the rows is never sorted in one task.
    """
    keys = list(keys)
    rows = groups.withColumn("_bin", F.substring(order, 1, 3))
    per_bin = rows.groupBy(*keys, size, "_bin").agg(F.count("*").alias("_c"))
    per_size = per_bin.groupBy(*keys, size).agg(F.sum("_c").alias("_s"))
    by_size = Window.partitionBy(*keys).orderBy(F.desc(size))
    per_size = per_size.withColumn("_before_size", F.sum("_s").over(by_size) - F.col("_s"))
    by_bin = Window.partitionBy(*keys, size).orderBy("_bin")
    offsets = (
        per_bin.withColumn("_before_bin", F.sum("_c").over(by_bin) - F.col("_c"))
        .join(per_size, [*keys, size])
        .select(*keys, size, "_bin", (F.col("_before_size") + F.col("_before_bin")).alias("_before"))
    )
    inside = Window.partitionBy(*keys, size, "_bin").orderBy(order)
    return (
        rows.withColumn("_rn", F.row_number().over(inside))
        .join(offsets, [*keys, size, "_bin"])
        .withColumn("rank", (F.col("_before") + F.col("_rn")).cast("bigint"))
        .drop("_bin", "_rn", "_before")
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    prob: float = 0.5,
    width: float = 1.0,
) -> DataFrame:
    """Exact interpolated quantile of several columns per key, in long form.

    Equal values are counted before the shuffle. A first pass over bins of
    ``width`` finds the bin of the wanted position, a second pass looks only at
    the values in that bin. ``width`` steers the balance, never the result.
    Returns keys, stat, value.
    """
    keys = list(keys)
    pairs = F.array(
        *[F.struct(F.lit(c).alias("stat"), F.col(c).cast("double").alias("v")) for c in columns]
    )
    counts = (
        df.select(*keys, F.explode(pairs).alias("p"))
        .select(*keys, "p.stat", "p.v")
        .where(F.col("v").isNotNull())
        .groupBy(*keys, "stat", "v")
        .agg(F.count("*").alias("c"))
        .withColumn("bin", F.floor(F.col("v") / F.lit(width)))
    )
    counts = settled(counts)
    group = [*keys, "stat"]
    bins = counts.groupBy(*group, "bin").agg(F.sum("c").alias("bc"))
    bins = bins.withColumn("upto", F.sum("bc").over(Window.partitionBy(*group).orderBy("bin")))
    bins = bins.withColumn("n", F.sum("bc").over(Window.partitionBy(*group)))
    position = (F.col("n") - 1) * F.lit(float(prob))
    wanted = F.array_distinct(F.array(F.floor(position), F.ceil(position)))
    chosen = (
        bins.withColumn("part", position - F.floor(position))
        .withColumn("at", F.explode(wanted))
        .where((F.col("at") >= F.col("upto") - F.col("bc")) & (F.col("at") < F.col("upto")))
        .select(*group, "bin", "at", "part", (F.col("upto") - F.col("bc")).alias("before"))
    )
    walk = Window.partitionBy(*group, "bin", "at").orderBy("v")
    hits = counts.join(chosen, [*group, "bin"]).withColumn(
        "end", F.col("before") + F.sum("c").over(walk)
    )
    hits = hits.where((F.col("at") >= F.col("end") - F.col("c")) & (F.col("at") < F.col("end")))
    return hits.groupBy(*group).agg(
        (F.min("v") + (F.max("v") - F.min("v")) * F.first("part")).alias("value")
    )


def range_shards(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Split rows into ordered, evenly filled shards and fix the split on disk."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settled(
        df.repartitionByRange(parts, *order).withColumn("_shard", F.spark_partition_id())
    )


def running_totals(df: DataFrame, order: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Running sums over the whole table in ``order``, without a one-task window.

    Every shard is summed on its own; the totals of earlier shards are added as
    an offset (one row per shard).
    """
    values = [expr.alias(f"_v_{name}") for name, expr in sums.items()]
    shards = range_shards(df.select("*", *values), order)
    totals = shards.groupBy("_shard").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    ordered = Window.partitionBy(F.lit(0)).orderBy("_shard")
    offsets = totals.select(
        "_shard", *[(F.sum(f"_t_{n}").over(ordered) - F.col(f"_t_{n}")).alias(f"_o_{n}") for n in sums]
    )
    inside = Window.partitionBy("_shard").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = shards.join(F.broadcast(offsets), "_shard")
    for n in sums:
        joined = joined.withColumn(n, F.sum(f"_v_{n}").over(inside) + F.col(f"_o_{n}"))
    return joined.drop("_shard", *[f"_v_{n}" for n in sums], *[f"_o_{n}" for n in sums])


def dense_ids(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number rows 0, 1, 2, ... in ``order``."""
    numbered = running_totals(df, order, {name: F.lit(1)})
    return numbered.withColumn(name, (F.col(name) - 1).cast("int"))
