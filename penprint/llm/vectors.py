"""Near-duplicate embeddings by PCA-ordered tiles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.llm.common import written
from penprint.llm.components import components
from penprint.operators.scale import lookup_join

THRESHOLD = 0.98
TILE = 1024  # vectors compared at a time
AXES = 4  # leading axes whose ranges rule out pairs of tiles
SLACK = 1e-9  # rounding of the rotated products; survivors are compared unrotated


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first, so that very large and very small ones keep theirs."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def usable(vectors: DataFrame, identity: str, vector: str, label: str) -> DataFrame:
    """Rows that can link: id, label, width, digest of the numbers, and the numbers as double bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, widths, digests, data = [], [], [], [], []
            for i, c, v in zip(*(batch.column(k) for k in ("id", "label", "v"))):
                v = v.values
                if v is None or not len(v) or v.null_count:
                    continue
                x = v.to_numpy(zero_copy_only=False).astype("<f8") + 0.0  # -0.0 becomes 0.0
                if np.isfinite(x).all() and x.any():
                    raw = x.tobytes()
                    ids.append(i.as_py()), labels.append(c.as_py()), widths.append(len(x))
                    digests.append(hashlib.md5(raw).digest()), data.append(raw)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(widths, pa.int32()), pa.array(digests, pa.binary()), pa.array(data, pa.binary())],
                ["id", "label", "width", "digest", "v"],
            )

    rows = vectors.where(F.col(label).isNotNull() & F.col(identity).isNotNull())
    rows = rows.select(F.col(identity).cast("bigint").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"))
    return rows.mapInArrow(pack, "id bigint, label string, width int, digest binary, v binary")


def principal_axes(rows: DataFrame) -> dict[int, np.ndarray]:
    """Axes by falling variance for every width; sums over all rows, one width² matrix per width on the driver.

    Any rotation gives the same links; this one lets the leading numbers tell most.
    """

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, part in batch.groupby("width"):
                x = unit(np.frombuffer(b"".join(part["v"]), "<f8").reshape(-1, width))
                total[width] = total.get(width, 0.0) + x.T @ x
        for width, matrix in total.items():
            yield pd.DataFrame({"width": [width] * width, "line": range(width), "sums": [list(r) for r in matrix]})

    lines = rows.select("width", "v").mapInPandas(moments, "width int, line int, sums array<double>")
    summed = (
        lines.select("width", "line", F.posexplode("sums").alias("column", "s"))
        .groupBy("width", "line", "column")
        .agg(F.sum("s").alias("s"))
    )
    axes = {}
    for width, part in summed.toPandas().groupby("width"):
        matrix = np.zeros((width, width))
        matrix[part["line"], part["column"]] = part["s"]
        values, found = np.linalg.eigh((matrix + matrix.T) / 2)
        axes[int(width)] = found[:, np.argsort(-values, kind="stable")]
    return axes


def tiles(classes: DataFrame, axes) -> DataFrame:
    """Vectors of one label and width in order of the first axis, cut into tiles of at most ``TILE``.

    A run of 16 tiles is put in order of the second axis, and each fourth of it in order of the third, so that the
    ranges on the leading axes are narrow. Range partitions split a label that holds most vectors.
    """

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = [
                float(unit(np.frombuffer(v, "<f8")[None])[0] @ axes.value[w][:, 0])
                for w, v in zip(batch.column("width").to_pylist(), batch.column("v").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first, pa.float64())], [*batch.schema.names, "lead"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, base = 0, TaskContext.get().partitionId() << 32

        def emit(rows: list[dict]) -> pa.RecordBatch:
            nonlocal number
            width = rows[0]["width"]
            data = np.frombuffer(b"".join(r["v"] for r in rows), "<f8").reshape(-1, width)
            turned = unit(data) @ axes.value[width][:, :AXES]
            order = np.argsort(turned[:, min(1, turned.shape[1] - 1)], kind="stable")
            out = []
            for quarter in range(0, len(rows), 4 * TILE):
                inner = order[quarter : quarter + 4 * TILE]
                inner = inner[np.argsort(turned[inner, min(2, turned.shape[1] - 1)], kind="stable")]
                for at in range(0, len(inner), TILE):
                    part = inner[at : at + TILE]
                    out.append(
                        {
                            "tile": base + number, "label": rows[0]["label"], "width": width,
                            "low": turned[part].min(axis=0).tolist(), "high": turned[part].max(axis=0).tolist(),
                            "ids": np.array([rows[k]["id"] for k in part], "<i8").tobytes(),
                            "n": np.array([rows[k]["n"] for k in part], "<i8").tobytes(),
                            "data": data[part].tobytes(),
                        }
                    )
                    number += 1
            return pa.RecordBatch.from_pylist(out, schema=kind)

        kind = pa.schema(
            [("tile", pa.int64()), ("label", pa.string()), ("width", pa.int32()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())),
             ("ids", pa.binary()), ("n", pa.binary()), ("data", pa.binary())]
        )
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (len(held) == 16 * TILE or (row["label"], row["width"]) != (held[0]["label"], held[0]["width"])):
                    yield emit(held)
                    held = []
                held.append(row)
        if held:
            yield emit(held)

    led = written(classes.mapInArrow(lead, "label string, width int, digest binary, id bigint, n bigint, v binary, lead double"), "vectors")
    ordered = led.repartitionByRange("label", "width", "lead", "id").sortWithinPartitions("label", "width", "lead", "id")
    found = ordered.mapInArrow(cut, "tile bigint, label string, width int, low array<double>, high array<double>, ids binary, n binary, data binary")
    return written(found, "tiles")


def close(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of ``a`` and ``b`` whose cosine reaches the threshold.

    Products accumulate over the leading axes; what the rest can add is at most the product of the suffix norms.
    Rows and columns with no pair left drop out, and the comparison stops when none is left.
    """
    width = a.shape[1]
    ua, ub = unit(a), unit(b)
    ra, rb = ua @ axes, ub @ axes
    tail_a = np.sqrt(np.maximum(np.cumsum((ra * ra)[:, ::-1], axis=1)[:, ::-1], 0))
    tail_b = np.sqrt(np.maximum(np.cumsum((rb * rb)[:, ::-1], axis=1)[:, ::-1], 0))
    left, right = np.arange(len(a)), np.arange(len(b))
    sums, done = np.zeros((len(a), len(b))), 0
    for stop in sorted({min(k, width) for k in (4, 8, 16, 32, 64, 128, 256, 512, width)}):
        sums += ra[left, done:stop] @ rb[right, done:stop].T
        done = stop
        rest = np.outer(tail_a[left, stop], tail_b[right, stop]) if stop < width else 0.0
        may = sums + rest >= threshold - SLACK
        keep_a, keep_b = may.any(axis=1), may.any(axis=0)
        if not keep_a.any():
            return left[:0], right[:0]
        if may.sum() < 4 * (keep_a.sum() + keep_b.sum()) or stop == width:
            i, j = np.nonzero(may)
            i, j = left[i], right[j]
            break
        if not (keep_a.all() and keep_b.all()):
            sums, left, right = sums[np.ix_(keep_a, keep_b)], left[keep_a], right[keep_b]
    good = np.empty(len(i), bool)
    for at in range(0, len(i), 1 << 16):
        part = slice(at, at + (1 << 16))
        good[part] = (ua[i[part]] * ub[j[part]]).sum(axis=1) >= threshold
    return i[good], j[good]


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links as stars around the smallest id of each group they connect; as many as there are linked ids at most."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = places[: len(a)], places[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(new[new], new):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, identity: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Links between vectors of equal label (and width) with cosine of at least ``threshold``.

    Adds n_links, component_id and kept to every row; other columns pass unchanged. Equal vectors are one class with a
    count; classes are compared tile by tile, and a pair of tiles returns at most one star link and one count per
    vector, never the pairs. Null, empty and zero vectors and those with null or non-finite numbers, and rows with a
    null label or id, link with nothing; they are their own component. Rows that share an id share its links.
    """
    spark = vectors.sparkSession
    rows = written(usable(vectors, identity, vector, label), "usable")
    classes = rows.groupBy("label", "width", "digest").agg(F.min("id").alias("id"), F.count_distinct("id").alias("n"), F.any_value("v").alias("v"))
    classes = written(classes, "classes")
    axes = spark.sparkContext.broadcast(principal_axes(classes))
    table = tiles(classes, axes)
    boxes = table.select("tile", "label", "width", "low", "high")
    gap = F.aggregate(
        F.zip_with(
            F.zip_with(F.col("x.low"), F.col("y.high"), lambda p, q: p - q),
            F.zip_with(F.col("y.low"), F.col("x.high"), lambda p, q: p - q),
            lambda p, q: F.greatest(p, q, F.lit(0.0)),
        ),
        F.lit(0.0),
        lambda s, g: s + g * g,
    )
    pairs = (
        boxes.alias("x")
        .join(boxes.alias("y"), (F.col("x.label") == F.col("y.label")) & (F.col("x.width") == F.col("y.width")) & (F.col("x.tile") <= F.col("y.tile")) & (gap <= 2 - 2 * threshold + SLACK))
        .select(F.col("x.tile").alias("tile"), F.col("y.tile").alias("other"))
    )
    bodies = table.select("tile", "width", "ids", "n", "data")
    seconds = bodies.select(F.col("tile").alias("other"), F.col("ids").alias("ids2"), F.col("n").alias("n2"), F.col("data").alias("data2"))
    work = written(pairs, "tile-pairs").join(bodies, "tile").join(seconds, "other")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                width, same = row["width"], row["tile"] == row["other"]
                ids, ids2 = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["ids2"], "<i8")
                n, n2 = np.frombuffer(row["n"], "<i8"), np.frombuffer(row["n2"], "<i8")
                i, j = close(np.frombuffer(row["data"], "<f8").reshape(-1, width), np.frombuffer(row["data2"], "<f8").reshape(-1, width), axes.value[width], threshold)
                if same:
                    i, j = i[i < j], j[i < j]
                if not len(i):
                    continue
                one = np.bincount(i, weights=n2[j], minlength=len(ids)).astype(np.int64)
                two = np.bincount(j, weights=n[i], minlength=len(ids2)).astype(np.int64)
                a, b = stars(ids[i], ids2[j])
                who = np.concatenate([ids[one > 0], ids2[two > 0], a])
                links = np.concatenate([one[one > 0], two[two > 0], np.zeros(len(a), np.int64)])
                to = pa.array(np.concatenate([np.zeros(len(who) - len(a), np.int64), b]), mask=np.arange(len(who)) < len(who) - len(a))
                yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(links), to], ["id", "links", "to"])

    small = work.select("tile", "other", "width", "ids", "n", "data", "ids2", "n2", "data2")
    found = written(small.mapInArrow(compare, "id bigint, links bigint, to bigint"), "vector-links")
    counts = found.where(F.col("to").isNull()).groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.where(F.col("to").isNotNull()), "id", "to")
    known = (
        classes.select("label", "width", "digest", "id", "n")
        .join(counts, "id", "left")
        .join(roots, "id", "left")
        .select(
            "label", "width", "digest",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    members = lookup_join(rows.select("id", "label", "width", "digest").distinct(), written(known, "vector-classes"), ["label", "width", "digest"], salt_on=["id"])
    per_id = members.groupBy("id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    per_id = per_id.select(F.col("id").alias("_id"), "n_links", "component_id")
    taken = [c for c in vectors.columns if c not in ("n_links", "component_id", "kept")]
    key = F.col(identity).cast("bigint")
    return (
        vectors.select(*taken, key.alias("_id"))
        .join(per_id, "_id", "left")
        .withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("bigint"))
        .withColumn("component_id", F.coalesce("component_id", "_id"))
        .withColumn("kept", F.col("_id").eqNullSafe(F.col("component_id")))
        .drop("_id")
    )


def op10_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label")
    return near_vectors(vectors).select("vec_id", "n_links", "component_id", "kept")
