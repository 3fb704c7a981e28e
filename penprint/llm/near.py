"""Near-duplicate documents: MinHash signatures joined through inverted lists of their coordinates."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.llm import words
from penprint.llm.common import bounded, written
from penprint.llm.components import components
from penprint.llm.vectors import stars
from penprint.operators.scale import fits_broadcast, lookup_join

WIDTH = 5  # words in a shingle
PERCENT = 75  # of the union that the intersection must reach
COORDINATES = 64
#: Coordinates that must agree. At a similarity of 0.75 fewer do in about one pair of 10^8.
MATCHES = 28
#: Pairs that agree in MATCHES coordinates agree in one of the first PREFIX at least.
PREFIX = COORDINATES - MATCHES + 1
PART = 100_000  # rows of a partition in tables of ids
TILE, TILE_BYTES = 1024, 2 << 20
FACTORS = np.random.default_rng(0xC0DE).integers(0, 1 << 63, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The smallest hash of every set under each coordinate's order, 4 bytes each; empty sets give 0."""
    out = np.zeros((len(bounds) - 1, COORDINATES), np.uint32)
    filled = np.flatnonzero(np.diff(bounds))
    if len(filled):
        starts = bounds[filled]
        for k in range(COORDINATES):
            out[filled, k] = np.minimum.reduceat(sets * FACTORS[k], starts) >> np.uint64(32)
    return out


def described(docs: DataFrame, identity: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """id, n_shingles, digest of the shingle set, signature of every row."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 1 << 19):
            sets, bounds = words.shingles(batch.column("text"), width)
            rows = signatures(sets, bounds)
            digests = [hashlib.md5(sets[a:b]).digest() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(bounds)), pa.array(digests, pa.binary()), pa.array([r.tobytes() for r in rows], pa.binary())],
                ["id", "n_shingles", "digest", "signature"],
            )

    rows = docs.select(F.col(identity).cast("bigint").alias("id"), "text")
    return rows.mapInArrow(describe, "id bigint, n_shingles bigint, digest binary, signature binary")


def hubs(classes: DataFrame) -> DataFrame:
    """Families of classes that share a coordinate of the prefix: hub, id.

    Every class is posted under each pair of coordinate and value in its prefix. The smallest id of a list is its hub;
    two classes of one list share that hub's family, so the families hold every pair that collides, while no list is
    gathered or paired. A list's minimum and count are combined before the shuffle.
    """

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = (np.arange(PREFIX, dtype=np.uint64) << np.uint64(32))[None]
        for batch in batches:
            n = batch.num_rows
            rows = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(n, COORDINATES)
            tokens = words.mix(rows[:, :PREFIX].astype(np.uint64) + place).view(np.int64)
            ids = np.repeat(np.asarray(batch.column("id")), PREFIX)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.ravel()), pa.array(ids)], ["token", "id"])

    posts = classes.select("id", "signature").mapInArrow(post, "token bigint, id bigint")
    lists = posts.groupBy("token").agg(F.min("id").alias("hub"), F.count("*").alias("n")).where("n > 1").select("token", "hub")
    return posts.join(lists, "token").select("hub", "id").distinct()


def matching(a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
    """Which rows of ``a`` and ``b`` agree in ``least`` columns; a block stops when no pair can reach that."""
    count = np.zeros((len(a), len(b)), np.uint8)
    width = a.shape[1]
    for k in range(width):
        count += a[:, k, None] == b[None, :, k]
        if k % 16 == 15 and int(count.max(initial=0)) + width - 1 - k < least:
            break
    return count >= least


def similar(a: list[np.ndarray], b: list[np.ndarray] | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets whose intersection reaches ``percent`` of their union, from products of 0/1 matrices.

    Without ``b`` the pairs within ``a``. Shingles that occur in one set alone are in no intersection; the others are
    multiplied 4096 columns at a time.
    """
    both = a if b is None else [*a, *b]
    first = slice(0, len(a))
    second = first if b is None else slice(len(a), len(both))
    sizes = np.array([len(s) for s in both], np.int64)
    values = np.concatenate(both) if both else np.zeros(0, np.uint64)
    order = np.argsort(values, kind="stable")
    owner, values = np.repeat(np.arange(len(both)), sizes)[order], values[order]
    column = np.cumsum(np.append(True, values[1:] != values[:-1])[: len(values)]) - 1
    often = np.bincount(column)[column] > 1 if len(column) else np.zeros(0, bool)
    rows, column = owner[often], column[often]
    column = np.cumsum(np.append(False, column[1:] != column[:-1])[: len(column)])
    total = np.zeros((len(sizes[first]), len(sizes[second])), np.float32)
    for low in range(0, int(column.max(initial=-1)) + 1, 4096):
        part = slice(*np.searchsorted(column, [low, low + 4096]))
        matrix = np.zeros((len(both), 4096), np.float32)
        matrix[rows[part], column[part] - low] = 1
        total += matrix[first] @ matrix[second].T
    union = sizes[first, None] + sizes[None, second] - total.astype(np.float64)
    hit = (100 * total.astype(np.float64) >= percent * union) & (total > 0)
    return np.nonzero(np.triu(hit, 1) if b is None else hit)


def family_links(families: DataFrame, classes: DataFrame, least: int = MATCHES) -> DataFrame:
    """Stars (a, b) around the smallest id of what the matching pairs of every family connect.

    Families in order of hub and id are cut into tiles; a family of several tiles is compared pair of tiles by pair
    of tiles, so that it is spread over tasks.
    """
    short = F.col("signature")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number, hub, held = TaskContext.get().partitionId() << 32, 0, None, []

        def tile() -> tuple:
            ids = np.array([i for i, _ in held], "<i8")
            data = np.frombuffer(b"".join(s for _, s in held), "<u4").reshape(-1, COORDINATES).astype(np.uint8)
            return (hub, base + number, ids.tobytes(), data.tobytes())

        names = ["hub", "tile", "ids", "data"]
        out: list[tuple] = []
        for batch in batches:
            for h, i, s in zip(*(batch.column(c).to_pylist() for c in ("hub", "id", "signature"))):
                if held and (h != hub or len(held) == TILE):
                    out.append(tile())
                    number, held = number + 1, []
                hub = h
                held.append((i, s))
            if len(out) >= 256:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
                out = []
        if held:
            out.append(tile())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)

    members = families.join(classes.select("id", short), "id")
    ordered = members.repartitionByRange("hub", "id").sortWithinPartitions("hub", "id").select("hub", "id", "signature")
    tiles = written(ordered.mapInArrow(cut, "hub bigint, tile bigint, ids binary, data binary"), "signature-tiles")
    spread = tiles.groupBy("hub").agg(F.count("*").alias("n")).where("n > 1").select("hub")
    columns, kind = ["ids", "data", "ids2", "data2"], "a bigint, b bigint"
    inside = tiles.withColumn("ids2", F.lit(None).cast("binary")).withColumn("data2", F.lit(None).cast("binary")).select(columns)
    spread = written(spread.coalesce(8), "large-families")
    large = tiles.join(spread, "hub", "left_semi")
    other = large.select("hub", F.col("tile").alias("tile2"), F.col("ids").alias("ids2"), F.col("data").alias("data2"))
    index = large.select("hub", "tile").join(other.select("hub", "tile2"), "hub").where("tile < tile2")
    pairs = index.join(large.drop("hub"), "tile").join(other.drop("hub"), "tile2")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for k in range(batch.num_rows):
                ids, data, ids2, data2 = (batch.column(c)[k].as_py() for c in ("ids", "data", "ids2", "data2"))
                same = ids2 is None
                ids2, data2 = (ids, data) if same else (ids2, data2)
                x, y = np.frombuffer(ids, "<i8"), np.frombuffer(ids2, "<i8")
                hit = matching(np.frombuffer(data, np.uint8).reshape(len(x), -1), np.frombuffer(data2, np.uint8).reshape(len(y), -1), least)
                i, j = np.nonzero(np.triu(hit, 1) if same else hit)
                if len(i):
                    found.append(stars(x[i], y[j]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[s] for f in found])) for s in (0, 1)], ["a", "b"])

    if not spread.limit(1).count():
        return inside.mapInArrow(compare, kind)
    return inside.mapInArrow(compare, kind).unionByName(pairs.select(columns).mapInArrow(compare, kind))


def confirmed(docs: DataFrame, clusters: DataFrame, identity: str, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Stars (a, b) of the links inside every cluster, from the full shingle sets of the whole texts.

    Rows in order of cluster and id are cut into tiles by number and bytes. A cluster within one tile is finished where
    it is; the tiles of a larger one are written and compared pair by pair.
    """
    sizes = clusters.groupBy("component").agg(F.count("*").alias("size"))
    wanted = clusters.join(sizes, "component").select(F.col("id").alias("_id"), "component", "size")
    texts = docs.select(F.col(identity).cast("bigint").alias("_id"), "text", F.xxhash64("text").alias("tie"))
    parts = max(8, -(-clusters.count() // PART))
    rows = lookup_join(texts, written(wanted.coalesce(parts), "wanted"), ["_id"], salt_on=["tie"])
    ordered = rows.repartitionByRange("component", "_id").sortWithinPartitions("component", "_id")

    def star(ids: np.ndarray, ids2: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, y = ids[i], ids2[j]
        return stars(x[x != y], y[x != y]) if len(i) else (ids[:0], ids[:0])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("cluster", pa.int64()), ("tile", pa.int64()), ("ids", pa.binary()), ("lengths", pa.binary()), ("sets", pa.binary())])
        base, number = TaskContext.get().partitionId() << 32, 0
        cluster, size, held, weight = None, 0, [], 0

        def tile() -> pa.RecordBatch:
            ids = np.array([i for i, _ in held], "<i8")
            flat, bounds = words.shingles(pa.array([t for _, t in held], pa.large_string()), width)
            sets = [flat[x:y] for x, y in zip(bounds[:-1], bounds[1:])]
            i, j = similar(sets, None, percent)
            a, b = star(ids, ids, i, j)
            out = [{"a": x, "b": y} for x, y in zip(a.tolist(), b.tolist())]
            if len(np.unique(ids)) < size:
                out.append({"cluster": cluster, "tile": base + number, "ids": ids.tobytes(), "lengths": np.diff(bounds).tobytes(), "sets": flat.tobytes()})
            return pa.RecordBatch.from_pylist(out, schema=kind)

        for batch in bounded(batches, 1 << 20):
            for c, n, i, t in zip(*(batch.column(x).to_pylist() for x in ("component", "size", "_id", "text"))):
                if held and (c != cluster or len(held) == TILE or weight + len(t or "") > TILE_BYTES):
                    yield tile()
                    number, held, weight = number + 1, [], 0
                cluster, size = c, n
                held.append((i, t or ""))
                weight += len(t or "")
        if held:
            yield tile()

    found = ordered.select("component", "size", "_id", "text").mapInArrow(
        cut, "a bigint, b bigint, cluster bigint, tile bigint, ids binary, lengths binary, sets binary"
    )
    found = written(found, "cluster-tiles")
    edges = found.where("a is not null").select("a", "b")
    if not found.where("tile is not null").limit(1).count():
        return edges
    bodies = found.where("tile is not null").select("cluster", "tile", "ids", "lengths", "sets")
    other = bodies.select("cluster", *[F.col(c).alias(c + "2") for c in ("tile", "ids", "lengths", "sets")])
    index = bodies.select("cluster", "tile").join(other.select("cluster", "tile2"), "cluster").where("tile < tile2")
    pairs = index.join(bodies.drop("cluster"), "tile").join(other.drop("cluster"), "tile2")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                sides = []
                for s in ("", "2"):
                    bounds = np.append(0, np.cumsum(np.frombuffer(row["lengths" + s], "<i8")))
                    flat = np.frombuffer(row["sets" + s], "<u8")
                    sides.append((np.frombuffer(row["ids" + s], "<i8"), [flat[x:y] for x, y in zip(bounds[:-1], bounds[1:])]))
                a, b = star(sides[0][0], sides[1][0], *similar(sides[0][1], sides[1][1], percent))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    across = pairs.select("ids", "lengths", "sets", "ids2", "lengths2", "sets2").mapInArrow(compare, "a bigint, b bigint")
    return edges.unionByName(across)


def near_duplicates(docs: DataFrame, identity: str = "doc_id") -> DataFrame:
    """id, n_shingles, component_id and kept of every row of ``docs``.

    Words are runs of characters other than ASCII white space, A-Z lower-cased; a document's set holds its distinct
    five-word shingles, the whole sequence if it has fewer words, nothing if it has none. Documents are linked whose
    intersection reaches 75 % of their union. Equal sets are one class from the start; classes whose signatures agree
    in enough coordinates form clusters, and only links confirmed on the full sets join documents. Empty sets and null
    ids link with nothing and keep themselves. Rows that share an id are one document: its links are those of all its
    rows, n_shingles is that of each row.
    """
    table = written(described(docs, identity), "signatures")
    usable = table.where("n_shingles > 0 and id is not null")
    classes = written(usable.groupBy("digest").agg(F.min("id").alias("id"), F.any_value("signature").alias("signature")), "classes")
    parts = max(8, -(-classes.count() // PART))  # of tables with a small row for each class
    families = written(hubs(classes).coalesce(parts), "families")
    clusters = components(written(family_links(families, classes), "candidates"))
    links = confirmed(docs, written(clusters, "clusters"), identity)
    # rows of one class, and of one id, are linked as they are
    members = usable.select("id", "digest").join(classes.select("digest", F.col("id").alias("class")), "digest")
    doubled = usable.groupBy("id").count().where("count > 1").limit(1).count() > 0
    if doubled:
        links = links.unionByName(members.where("id <> class").select(F.col("id").alias("a"), F.col("class").alias("b")))
    roots = components(written(links, "confirmed"))
    known = roots.select(F.col("id").alias("class"), "component")
    by_class = written(classes.select("digest", F.col("id").alias("class")).join(known, "class", "left").select("digest", F.coalesce("component", "class").alias("component")).coalesce(parts), "class-roots")
    out = lookup_join(table, by_class, ["digest"], "left", salt_on=["id"])
    component = F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id"))
    out = out.select("id", "n_shingles", component.alias("component_id"))
    if doubled:
        least = out.where("id is not null").groupBy("id").agg(F.min("component_id").alias("component_id"))
        out = out.drop("component_id").join(least, "id", "left")
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, identity: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose document is the first of its group; of rows that share an id, one stays."""
    table = written(near_duplicates(docs, identity), "near")
    if table.where("id is not null").groupBy("id").count().where("count > 1").limit(1).count():
        docs = docs.where(F.col(identity).isNull()).unionByName(docs.where(F.col(identity).isNotNull()).dropDuplicates([identity]))
    gone = written(table.where("not kept").select(F.col("id").alias("_gone")).distinct(), "gone")
    if fits_broadcast(gone):
        gone = F.broadcast(gone)
    return docs.join(gone, F.col(identity).cast("bigint") == F.col("_gone"), "left_anti")


def op6_near(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")
