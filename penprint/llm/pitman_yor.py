"""A hierarchical Pitman-Yor language model of words, learned and applied on Spark.

Every word that occurs as a context has a restaurant whose dishes are the words that follow it; all of them share one
parent restaurant of words, whose base is uniform over the known words and one place for all others. Customers sit at
tables by the two-parameter Chinese restaurant process; Gibbs sweeps seat them anew and some of the seatings are kept.
A word's probability is the average of its predictive probabilities under the kept seatings.

The corpus is cut into blocks of a few megabytes. A block sends its distinct words and word pairs, with their training
counts, to the partition that owns each of them; there the counts meet, customers are seated, and what the block needs
for scoring goes back to it in the order in which it asked. Words are sent by their hashes once; the partition that owns
a word numbers it, and pairs are sent by these numbers. So nothing of the size of the corpus is collected or
broadcast, and every word pair crosses the network once a block. A context with many customers is split over
partitions by the following word.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.llm import words
from penprint.llm.common import bounded, written
from penprint.llm.labelled import remainder_is

BLOCK = 4 << 20  # text bytes of a block
KEY = 64  # bits of the hash that names a word; two of a hundred million words share it once in 3,700 corpora
DISCOUNT = (0.75, 0.8)  # of the parent, of the contexts
STRENGTH = (1.0, 1.0)
SWEEPS, KEPT = 4, 2  # the last KEPT of the sweeps are kept
SEED = 11
END = np.uint64(0xE0D0_0000_0000_0001)
START = 0  # the context at the beginning of a document, beside the words' numbers
SCHEMA = "block bigint, bucket int, kind int, a binary, b binary, c binary, d binary, e binary"
FIELDS = [("block", pa.int64()), ("bucket", pa.int32()), ("kind", pa.int32()), *((c, pa.binary()) for c in "abcde")]


def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest needs, the bytes of one place together, compressed."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    planes = np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(-1, kind.itemsize).T)
    return kind.str[1:].encode() + zstandard.compress(planes.tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    kind = np.dtype(data[:2].decode())
    planes = np.frombuffer(zstandard.decompress(data[2:]), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind)[:, 0].astype(np.int64)


def pack_keys(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : KEY // 8]).tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // (KEY // 8), 8), np.uint8)
    out[:, : KEY // 8] = np.frombuffer(data, np.uint8).reshape(-1, KEY // 8)
    return out.view("<u8")[:, 0]


def pack_rising(numbers: np.ndarray) -> bytes:
    return pack(np.diff(numbers, prepend=0))


def unpack_rising(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data))


def rows_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, FIELDS)], [n for n, _ in FIELDS])


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Rows of each run of equal keys."""
    held: list[dict] = []
    for batch in batches:
        for k in range(batch.num_rows):
            row = {n: batch.column(n)[k].as_py() for n in batch.schema.names}
            if held and held[0][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def blocks_of(docs: DataFrame, identity: str, learn) -> DataFrame:
    """Documents in blocks: a: ids, b: 1 for null ids and 2 for training, c: tokens per document, d: words, e: places.

    A document's tokens are places in its block's list of distinct words; each ends with the end token.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def block() -> pa.RecordBatch:
            ids, flags, counts, hashes = (np.concatenate([h[k] for h in held]) for k in range(4))
            known, places, often = np.unique(hashes >> np.uint64(64 - KEY), return_inverse=True, return_counts=True)
            order = np.argsort(-often, kind="stable")  # small places for frequent words
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            name = uuid.uuid4().int >> 65
            return rows_of([(name, 0, 0, ids.tobytes(), flags.tobytes(), pack(counts), pack_keys(known[order]), pack(rank[places]))])

        size = 0
        for batch in bounded(batches, BLOCK // 4):
            found, bounds = words.word_hashes(batch.column("text"))
            n = len(bounds) - 1
            # one end token after each document's words
            hashes = np.full(len(found) + n, END, np.uint64)
            at = np.arange(len(found)) + np.repeat(np.arange(n), np.diff(bounds))
            hashes[at] = found
            ids = batch.column("id")
            flags = np.asarray(ids.is_null()).astype(np.uint8) + 2 * np.asarray(batch.column("learn").cast(pa.uint8()))
            held.append((np.asarray(ids.fill_null(0)).astype("<i8"), flags.astype(np.uint8), np.diff(bounds) + 1, hashes))
            size += words.flat(batch.column("text"))[0].size
            if size >= BLOCK:
                yield block()
                held, size = [], 0
        if held:
            yield block()

    rows = docs.select(F.col(identity).cast("bigint").alias("id"), learn.alias("learn"), "text")
    return rows.mapInArrow(cut, SCHEMA)


def opened(row: dict) -> dict:
    """A block's arrays; every token with its context."""
    counts, known, places = unpack(row["c"]), unpack_keys(row["d"]), unpack(row["e"])
    flags = np.frombuffer(row["b"], np.uint8)
    first = np.append(0, np.cumsum(counts))[:-1]
    before = np.empty_like(places)
    before[1:] = places[:-1]
    before[first] = len(known)  # the start of a document
    learn = np.repeat(flags & 2 > 0, counts)
    return {"ids": np.frombuffer(row["a"], "<i8"), "flags": flags, "counts": counts, "known": known, "places": places, "before": before, "learn": learn}


def word_requests(row: dict, buckets: int) -> list[tuple]:
    """Distinct words by owner: a: keys, b: training counts, c: their places in the block's list."""
    block = opened(row)
    keys = block["known"]
    counts = np.bincount(block["places"][block["learn"]], minlength=len(keys))
    owner = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    ends = np.searchsorted(owner[order], np.arange(buckets + 1))
    out = []
    for k in range(buckets):
        part = order[ends[k] : ends[k + 1]]
        if len(part):
            out.append((row["block"], k, 1, pack_keys(keys[part]), pack(counts[part]), None, None, None))
    return out


def numbered(total: np.ndarray, bucket: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a partition's words, small ones for frequent words, and the words in the order of their numbers.

    The remainder by ``buckets`` is the partition, so words of different partitions have different numbers.
    """
    order = np.argsort(-total, kind="stable")
    numbers = np.empty(len(order), np.int64)
    numbers[order] = (np.arange(len(order)) + 1) * buckets + bucket
    return numbers, order


def answered(rows: list[dict], buckets: int) -> tuple[dict, np.ndarray, np.ndarray]:
    """A block, and the training counts and numbers of its words, from its row and the answers to its word requests."""
    block = opened(rows[0])
    order = np.argsort((block["known"] % np.uint64(buckets)).astype(np.int64), kind="stable")
    found = [r for r in rows if r["kind"] == 1]
    count, numbers = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    count[order] = np.concatenate([unpack(r["a"]) for r in found])
    numbers[order] = np.concatenate([unpack(r["b"]) for r in found])
    return block, count, numbers


def pair_owners(u: np.ndarray, w: np.ndarray, hot: tuple[np.ndarray, np.ndarray], buckets: int) -> np.ndarray:
    """The partition of a context, or of one of the parts into which a frequent context is split."""
    at = np.minimum(np.searchsorted(hot[0], u), max(0, len(hot[0]) - 1))
    parts = np.where(hot[0][at] == u, hot[1][at], 1) if len(hot[0]) else np.ones(len(u), np.int64)
    return (u + (words.mix(w.astype(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)) % buckets


def pairs_of(block: dict, numbers: np.ndarray, hot, buckets: int) -> tuple:
    """The block's distinct (context, word) pairs by owner and number: context and word places, owners, each token's pair."""
    n = len(block["known"]) + 1
    keys = np.append(numbers, START)
    pair, token = np.unique(block["before"] * n + block["places"], return_inverse=True)
    u, w = pair // n, pair % n
    owner = pair_owners(keys[u], keys[w], hot, buckets)
    order = np.lexsort((keys[w], keys[u], owner))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return u[order], w[order], owner[order], rank[token], keys


def pair_requests(rows: list[dict], hot, buckets: int) -> list[tuple]:
    """Distinct pairs by owner: a: contexts, b: words after each, c: the distinct words' numbers, then their training
    counts, d: training counts of the pairs, e: the place of each pair's word."""
    block, total, numbers = answered(rows, buckets)
    u, w, owner, token, keys = pairs_of(block, numbers, hot, buckets)
    counts = np.bincount(token[block["learn"]], minlength=len(u))
    ends = np.searchsorted(owner, np.arange(buckets + 1))
    out = []
    for k in range(buckets):
        part = slice(ends[k], ends[k + 1])
        if ends[k] == ends[k + 1]:
            continue
        runs = np.flatnonzero(np.append(True, u[part][1:] != u[part][:-1]))
        lengths = np.diff(np.append(runs, ends[k + 1] - ends[k]))
        follow, first, place = np.unique(keys[w[part]], return_index=True, return_inverse=True)
        follow = pack(np.append(np.diff(follow, prepend=0), total[w[part][first]]))
        out.append((rows[0]["block"], k, 2, pack_rising(keys[u[part][runs]]), pack(lengths), follow, pack(counts[part]), pack(place)))
    return out


def seated(rng, customers: np.ndarray, mass: np.ndarray, discount: float) -> np.ndarray:
    """Tables after seating all customers of every dish one after another.

    ``mass`` is (strength + discount * the restaurant's other tables) * the parent's probability of the dish. The
    first customer opens a table, the next a new one with probability mass / (mass + seated - discount * tables). From
    64 customers on they come in groups that double, each with the rate in the group's middle.
    """
    tables = (customers > 0).astype(np.float64)
    for i in range(1, 64):
        active = np.flatnonzero(customers > i)
        if not len(active):
            return tables
        a = mass[active]
        tables[active] += rng.random(len(active)) < a / (a + np.maximum(i - discount * tables[active], 1e-9))
    low = 64
    while True:
        active = np.flatnonzero(customers > low)
        if not len(active):
            return tables
        n = np.minimum(customers[active], 2 * low) - low
        a = mass[active]
        rate = a / (a + np.maximum(low + n / 2 - discount * tables[active], 1e-9))
        tables[active] += rng.binomial(n.astype(np.int64), rate)
        low *= 2


def sampled(seed: int, restaurant: np.ndarray, parts: np.ndarray, customers: np.ndarray, parent: np.ndarray, discount: float, strength: float) -> np.ndarray:
    """Kept numbers of tables per dish. ``parts``: over how many partitions the dish's restaurant is split."""
    rng = np.random.default_rng(seed)
    tables, kept = (customers > 0).astype(np.float64), []
    n = int(restaurant.max(initial=-1)) + 1
    many = np.flatnonzero(customers > 1)  # a single customer has one table whatever the others do
    for sweep in range(SWEEPS):
        total = np.bincount(restaurant, weights=tables, minlength=n)[restaurant[many]] * parts[many]
        mass = (strength + discount * np.maximum(total - tables[many], 0)) * parent[many]
        tables[many] = seated(rng, customers[many], mass, discount)
        if sweep >= SWEEPS - KEPT:
            kept.append(tables.copy())
    return np.array(kept)


def scored(docs: DataFrame, learn, identity: str = "doc_id", buckets: int | None = None) -> DataFrame:
    """Score every whole text with the model learned from the rows for which ``learn`` holds.

    Returns id, learned, n_tokens, n_known, train_tokens, base_score, score. Words are runs of characters other than
    ASCII white space, A-Z lower-cased, and an end token; null and empty texts are the end token alone. base_score is
    that of add-half smoothed word frequencies; score is log10 of the averaged predictive probabilities. With nothing
    to learn from both are 0. Repeated rows count as often as they occur. While the contexts are seated, the parent's
    probabilities are taken from the word counts; the parent is then seated with the contexts' tables as customers.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = written(blocks_of(docs, identity, F.coalesce(learn, F.lit(False))), "blocks")

    def request(batches, make, *more):
        for batch in batches:
            for k in range(batch.num_rows):
                yield rows_of(make({n: batch.column(n)[k].as_py() for n in batch.schema.names}, *more))

    def owned(df: DataFrame) -> DataFrame:
        return df.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "kind", "block")

    asked = blocks.mapInArrow(lambda b: request(b, word_requests, buckets), SCHEMA)
    sizes = blocks.mapInArrow(learned_docs, "n bigint, tokens bigint").agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens")).first()
    starts, learned = sizes["n"] or 0, sizes["tokens"] or 0

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, "bucket"):
            keys = [unpack_keys(r["a"]) for r in rows]
            known, place = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(place, weights=np.concatenate([unpack(r["b"]) for r in rows])).astype(np.int64)
            numbers, _ = numbered(total, rows[0]["bucket"], buckets)
            ends = np.append(0, np.cumsum([len(k) for k in keys]))
            for k, r in enumerate(rows):
                mine = place[ends[k] : ends[k + 1]]
                yield rows_of([(r["block"], r["bucket"], 1, pack(total[mine]), pack(numbers[mine]), None, None, None)])
            seen = total > 0
            sums = np.array([total.sum(), seen.sum()], "<i8")
            often = total * 4 * buckets > learned
            yield rows_of([(None, rows[0]["bucket"], 9, sums.tobytes(), numbers[often].tobytes(), total[often].tobytes(), None, None)])

    counted = written(owned(asked).mapInArrow(count_words, SCHEMA), "word-counts")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [np.frombuffer(x, "<i8") for x in batch.column("a").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([int(s[k]) for s in sums], pa.int64()) for k in (0, 1)], ["n", "v"])

    found = counted.where("kind = 9").select("a").mapInArrow(totals, "n bigint, v bigint").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    tokens, types = found["n"] or 0, found["v"] or 0

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, c in zip(batch.column("b").to_pylist(), batch.column("c").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b, np.int64)), pa.array(np.frombuffer(c, np.int64))], ["w", "n"])

    # contexts with more than a quarter of a partition's share of the tokens are split
    top = counted.where("kind = 9").select("b", "c").mapInArrow(common, "w bigint, n bigint").toPandas().sort_values("w")
    hot_words, hot_parts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(top):
        hot_words, hot_parts = top["w"].to_numpy(), np.ceil(top["n"].to_numpy() * 4.0 * buckets / max(1, tokens)).astype(np.int64)
    if starts * 4 * buckets > tokens:
        hot_words = np.append(hot_words, START)
        hot_parts = np.append(hot_parts, int(np.ceil(starts * 4 * buckets / max(1, tokens))))
        order = np.argsort(hot_words)
        hot_words, hot_parts = hot_words[order], hot_parts[order]
    names = spark.sparkContext.broadcast((hot_words, hot_parts))

    def request_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, "block"):
            yield rows_of(pair_requests(rows, names.value, buckets))

    with_words = blocks.unionByName(counted.where("kind = 1")).repartition("block").sortWithinPartitions("block", "kind", "bucket")
    pair_asked = with_words.mapInArrow(request_pairs, SCHEMA)

    def seat_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = names.value
        for rows in grouped(batches, "bucket"):
            bucket = rows[0]["bucket"]
            sizes = [unpack(r["b"]) for r in rows]
            us = [np.repeat(unpack_rising(r["a"]), s) for r, s in zip(rows, sizes)]
            follow = [unpack(r["c"]).reshape(2, -1) for r in rows]  # words and their counts in the whole training part
            at = [unpack(r["e"]) for r in rows]
            u, w = np.concatenate(us), np.concatenate([np.cumsum(f[0])[a] for f, a in zip(follow, at)])
            parent = np.concatenate([f[1][a] for f, a in zip(follow, at)]) / max(1, tokens)
            _, first, place = np.unique(u * (int(w.max()) + 1) + w, return_index=True, return_inverse=True)
            customers = np.bincount(place, weights=np.concatenate([unpack(r["d"]) for r in rows])).astype(np.int64)
            u, w, parent = u[first], w[first], parent[first]
            names_u, restaurant = np.unique(u, return_inverse=True)
            at = np.minimum(np.searchsorted(hot[0], u), max(0, len(hot[0]) - 1))
            many = np.where(hot[0][at] == u, hot[1][at], 1) if len(hot[0]) else np.ones(len(u), np.int64)
            tables = sampled(SEED * 1_000_003 + bucket, restaurant, many, customers, parent, DISCOUNT[1], STRENGTH[1]).astype(np.int64)
            sums = np.array([np.bincount(restaurant, weights=t, minlength=len(names_u)) for t in tables]).astype(np.int64)
            ends, heads = np.append(0, np.cumsum([len(x) for x in us])), 0
            for k, r in enumerate(rows):
                mine = place[ends[k] : ends[k + 1]]
                begin = np.append(0, np.cumsum(sizes[k]))[:-1]
                yield rows_of([(r["block"], bucket, 2, pack(customers[mine]), pack(tables[:, mine].ravel()), pack(sums[:, restaurant[mine[begin]]].ravel()), None, None)])
            wide = np.isin(names_u, hot[0])
            if wide.any():
                yield rows_of([(None, bucket, 8, names_u[wide].tobytes(), sums[:, wide].tobytes(), None, None, None)])
            # the tables are the parent's customers, by word
            seen = customers > 0
            known, place_w = np.unique(w[seen], return_inverse=True)
            guests = np.array([np.bincount(place_w, weights=t[seen], minlength=len(known)) for t in tables]).astype(np.int64).reshape(KEPT, -1)
            owner = known % buckets
            order = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[order], np.arange(buckets + 1))
            out = []
            for k in range(buckets):
                part = order[cuts[k] : cuts[k + 1]]
                if len(part):
                    out.append((None, k, 0, pack_rising(known[part]), pack(guests[:, part].ravel()), None, None, None))
            yield rows_of(out)

    seats = written(owned(pair_asked).mapInArrow(seat_pairs, SCHEMA), "pair-seats")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                name, n = np.frombuffer(a, np.int64), np.frombuffer(b, "<i8").reshape(KEPT, -1)
                yield pa.RecordBatch.from_arrays([pa.array(np.tile(name, KEPT)), pa.array(np.repeat(np.arange(KEPT), len(name))), pa.array(n.ravel())], ["u", "s", "n"])

    # frequent contexts: at most four parts a partition
    wide = seats.where("kind = 8").select("a", "b").mapInArrow(gather, "u bigint, s bigint, n bigint").groupBy("u", "s").agg(F.sum("n").alias("n")).toPandas()
    wide_tables = np.zeros((KEPT, len(hot_words)), np.int64)
    if len(wide):
        wide_tables[wide["s"], np.searchsorted(hot_words, wide["u"].to_numpy())] = wide["n"]

    def seat_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, "bucket"):
            guests, asks = [r for r in rows if r["kind"] == 0], [r for r in rows if r["kind"] == 1]
            keys = [unpack_keys(r["a"]) for r in asks]
            known, place = np.unique(np.concatenate(keys), return_inverse=True) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            total = np.bincount(place, weights=np.concatenate([unpack(r["b"]) for r in asks]) if asks else None, minlength=len(known))
            _, order = numbered(total.astype(np.int64), rows[0]["bucket"], buckets)
            customers = np.zeros((KEPT, len(known)), np.int64)
            for r in guests:
                customers[:, order[unpack_rising(r["a"]) // buckets - 1]] += unpack(r["b"]).reshape(KEPT, -1)
            tables = []
            for s in range(KEPT):  # the parent's other tables: about one for each known word
                rng = np.random.default_rng([SEED, s, rows[0]["bucket"]])
                mass = np.full(len(known), (STRENGTH[0] + DISCOUNT[0] * types) / (types + 1))
                tables.append(seated(rng, customers[s], mass, DISCOUNT[0]))
            tables = np.array(tables).astype(np.int64).reshape(KEPT, -1)
            ends = np.append(0, np.cumsum([len(k) for k in keys]))
            for k, r in enumerate(asks):
                mine = place[ends[k] : ends[k + 1]]
                yield rows_of([(r["block"], r["bucket"], 3, pack(customers[:, mine].ravel()), pack(tables[:, mine].ravel()), None, None, None)])
            yield rows_of([(None, rows[0]["bucket"], 7, np.append(customers.sum(axis=1), tables.sum(axis=1)).astype("<i8").tobytes(), None, None, None, None)])

    parents = written(owned(asked.unionByName(seats.where("kind = 0"))).mapInArrow(seat_words, SCHEMA), "word-seats")

    def parent_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.array([np.frombuffer(x, "<i8") for x in batch.column("a").to_pylist()]).reshape(-1, 2 * KEPT)
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(2 * KEPT), len(sums))), pa.array(sums.ravel())], ["k", "n"])

    sums = np.zeros(2 * KEPT)
    for r in parents.where("kind = 7").select("a").mapInArrow(parent_sums, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect():
        sums[r["k"]] = r["n"]
    parent_customers, parent_tables = sums[:KEPT], sums[KEPT:]
    facts = spark.sparkContext.broadcast((hot_words, hot_parts, wide_tables))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, wide_sums = facts.value[:2], facts.value[2]
        for rows in grouped(batches, "block"):
            block, count, numbers = answered(rows, buckets)
            n = len(count)
            order = np.argsort(numbers % buckets, kind="stable")
            kinds = {k: [r for r in rows if r["kind"] == k] for k in (2, 3)}
            customers, tables = np.empty((KEPT, n)), np.empty((KEPT, n))
            customers[:, order] = np.concatenate([unpack(r["a"]).reshape(KEPT, -1) for r in kinds[3]], axis=1)
            tables[:, order] = np.concatenate([unpack(r["b"]).reshape(KEPT, -1) for r in kinds[3]], axis=1)
            d0, s0 = DISCOUNT[0], STRENGTH[0]
            open0 = (s0 + d0 * parent_tables) / (types + 1)
            word = (customers - d0 * tables + open0[:, None]) / (s0 + parent_customers)[:, None]
            u, w, owner, token, all_keys = pairs_of(block, numbers, hot, buckets)
            c = np.concatenate([unpack(r["a"]) for r in kinds[2]])
            t = np.concatenate([unpack(r["b"]).reshape(KEPT, -1) for r in kinds[2]], axis=1)
            # a run of equal contexts with one owner has one sum
            run = np.append(True, (u[1:] != u[:-1]) | (owner[1:] != owner[:-1]))
            total = np.concatenate([unpack(r["c"]).reshape(KEPT, -1) for r in kinds[2]], axis=1)[:, np.cumsum(run) - 1].astype(np.float64)
            if len(hot[0]):
                at = np.minimum(np.searchsorted(hot[0], all_keys[u]), len(hot[0]) - 1)
                is_hot = hot[0][at] == all_keys[u]
                total[:, is_hot] = wide_sums[:, at[is_hot]]
            of = np.append(count, starts)[u]
            d1, s1 = DISCOUNT[1], STRENGTH[1]
            p = ((c - d1 * t) + (s1 + d1 * total) * word[:, w]) / (s1 + of)
            logs = np.log10(p.mean(axis=0))
            base = np.log10((count + 0.5) / (tokens + 0.5 * (types + 1)))
            doc = np.repeat(np.arange(len(block["counts"])), block["counts"])
            m = len(block["counts"])
            places = block["places"]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block["ids"], mask=block["flags"] & 1 > 0),
                    pa.array(block["flags"] & 2 > 0),
                    pa.array(block["counts"]),
                    pa.array(np.bincount(doc, weights=count[places] > 0, minlength=m).astype(np.int64)),
                    pa.array(np.full(m, tokens)),
                    pa.array(np.bincount(doc, weights=base[places], minlength=m)),
                    pa.array(np.bincount(doc, weights=logs[token], minlength=m)),
                ],
                ["id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    answers = counted.where("kind = 1").unionByName(seats.where("kind = 2")).unionByName(parents.where("kind = 3"))
    together = blocks.unionByName(answers).repartition("block").sortWithinPartitions("block", "kind", "bucket")
    return together.mapInArrow(score, "id bigint, learned boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def learned_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and tokens to learn from."""
    for batch in batches:
        for b, c in zip(batch.column("b").to_pylist(), batch.column("c").to_pylist()):
            learn = np.frombuffer(b, np.uint8) & 2 > 0
            yield pa.RecordBatch.from_arrays([pa.array([int(learn.sum())], pa.int64()), pa.array([int(unpack(c)[learn].sum())], pa.int64())], ["n", "tokens"])


def with_perplexity(scores: DataFrame) -> DataFrame:
    """Add the perplexity per token of every scored text."""
    return scores.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op8_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    out = with_perplexity(scored(docs, ~remainder_is("doc_id", 5, 1)))
    return out.select(
        F.col("id").alias("doc_id"), (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"
    )
