"""Phrase collocations by direct-address tiling.

Words get ids by descending frequency. A pair of neighbours is a cell of a square with the two ids as coordinates; both
sides are cut into bands of equal mass, so frequent words lie in narrow bands and every tile (band x band) holds a like
share of the pairs. A narrow tile is counted in a dense array with ``bincount``, a wide one as sorted coordinates and
counts. Frequent pairs are ranked anew and take the place of the left word, which turns three words into a pair of
(pair, word), and four into one of (triple, word).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.llm.common import bounded, written
from penprint.llm.words import LOWER, flat
from penprint.operators.scale import lookup_join, running_totals

LEAST = 30  # occurrences of a candidate
LONGEST = 4  # words of a candidate
COVERED = 80  # per cent of the occurrences that a longer candidate must have
MOST = 2000  # phrases of a language
SCALE = 2_000_000
BLOCK = 4 << 20  # text bytes of a block
TILE = 1 << 20  # a side has the cube root of pairs / TILE bands
CELLS = 1 << 22  # cells of a tile that is counted in a dense array

BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
SPACES = BREAKS.copy()
SPACES[[0x20, 0x09]] = True


def pack(values: np.ndarray) -> bytes:
    """Whole numbers, -1 and up, in as few bytes each as the largest needs; the first byte names the width."""
    width = next(w for w in (1, 2, 4, 8) if not len(values) or int(values.max()) < 1 << (8 * w - 1))
    return bytes([width]) + values.astype(f"<i{width}").tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64)


def slices(data: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Cut a text's bytes behind the first break after every ``most`` bytes; no piece is cut."""
    begin = 0
    while len(data) - begin > most:
        step = begin + most
        while step < len(data) and not (hit := BREAKS[data[step : step + most]]).any():
            step += most
        if step >= len(data):
            break
        end = step + int(hit.argmax()) + 1
        yield data[begin:end]
        begin = end
    yield data[begin:]


def tokens_of(data: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of lower-cased bytes in order, and the number of breaks before each of them."""
    out = np.append(SPACES[data], True)
    begins = np.flatnonzero(~out[:-1] & np.append(True, out[:-2]))
    ends = np.flatnonzero(~out[:-1] & out[1:]) + 1
    offsets = np.append(0, np.cumsum(ends - begins)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data[~out[:-1]])])
    return words, np.cumsum(BREAKS[data])[begins]


def broken(ids: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """The ids with a -1 between pieces."""
    return np.insert(ids, np.flatnonzero(np.diff(piece)) + 1, -1) if len(ids) else ids


def squeezed(ids: np.ndarray) -> np.ndarray:
    """Leave out every -1 that follows another."""
    keep = np.ones(len(ids), bool)
    keep[1:] = (ids[1:] >= 0) | (ids[:-1] >= 0)
    return ids[keep]


def blocks_of(docs: DataFrame, text: str, lang: str, block: int) -> DataFrame:
    """Blocks of about ``block`` text bytes of one language: block, lang, n, words, counts, stream.

    ``stream`` has the words as places in ``words``, with -1 between pieces and texts.
    """

    def emit(number: int, lang: str, parts: list[np.ndarray]) -> pa.RecordBatch:
        data = np.concatenate([x for p in parts for x in (p, np.array([0x0A], np.uint8))])
        words, piece = tokens_of(LOWER[data])
        coded = words.dictionary_encode()
        ids = np.asarray(coded.indices, np.int64)
        counts = np.bincount(ids, minlength=len(coded.dictionary)).astype(np.int64)
        one = pa.array([0, len(counts)], pa.int32())
        columns = [
            pa.array([number]), pa.array([lang]), pa.array([len(ids)]),
            pa.ListArray.from_arrays(one, coded.dictionary.cast(pa.large_string()).cast(pa.string())),
            pa.ListArray.from_arrays(one, pa.array(counts)), pa.array([pack(broken(ids, piece))], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["block", "lang", "n", "words", "counts", "stream"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[str, list[np.ndarray]] = {}
        size: dict[str, int] = {}
        for batch in bounded(batches, block, "text"):
            data, bounds = flat(batch.column("text"))
            for k, name in enumerate(batch.column("lang").to_pylist()):
                for part in slices(data[bounds[k] : bounds[k + 1]], block):
                    held.setdefault(name, []).append(part.copy())
                    size[name] = size.get(name, 0) + len(part)
                    if size[name] >= block:
                        yield emit(number, name, held.pop(name))
                        number += 1
                        del size[name]
            while sum(size.values()) > 4 * block:
                name = max(size, key=lambda x: size[x])
                yield emit(number, name, held.pop(name))
                number += 1
                del size[name]
        for name in sorted(held):
            yield emit(number, name, held[name])
            number += 1

    rows = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang")).where("text <> ''")
    schema = "block bigint, lang string, n bigint, words array<string>, counts array<bigint>, stream binary"
    return written(rows.mapInArrow(run, schema), "blocks")


def ranked(items: DataFrame, order: list[Column | str], label: str) -> DataFrame:
    """Adds ``id``, 0 for the most frequent item of a language, and ``upto``, the occurrences of all before it."""
    items = running_totals(items, ["lang", F.desc("a"), *order], {"id": F.lit(1), "upto": F.col("a")})
    items = written(items.withColumn("id", F.col("id") - 1).withColumn("upto", F.col("upto") - F.col("a")), label)
    first = items.groupBy("lang").agg(F.min("id").alias("_id"), F.min("upto").alias("_upto"))
    items = lookup_join(items, first, ["lang"], salt_on=["id"])
    return items.withColumn("id", F.col("id") - F.col("_id")).withColumn("upto", F.col("upto") - F.col("_upto")).drop("_id", "_upto")


def bands_of(items: DataFrame, tile: int) -> dict[str, np.ndarray]:
    """First ids of the bands of every language that has more than one; a band has a like share of the occurrences.

    The number of bands grows as the cube root of the occurrences, so this is a small table at any size.
    """
    total = items.groupBy("lang").agg(F.sum("a").alias("total"))
    total = total.withColumn("bands", F.ceil(F.cbrt(F.col("total") / F.lit(float(tile))))).where("bands > 1")
    cut = lookup_join(items, total, ["lang"], salt_on=["id"])
    band = F.floor(F.col("upto") * F.col("bands") / F.col("total"))
    rows = cut.groupBy("lang", band.alias("band")).agg(F.min("id").alias("first")).collect()
    bands: dict[str, list[int]] = {}
    for r in rows:
        bands.setdefault(r["lang"], []).append(r["first"])
    return {lang: np.array(sorted(firsts), np.int64) for lang, firsts in bands.items()}


class Grid:
    """Tiles of the pairs of one level: bands of the left and of the right ids, per language."""

    ONE = np.zeros(1, np.int64)

    def __init__(self, left: dict, right: dict, sizes: dict):
        self.left, self.right, self.sizes = left, right, sizes

    def place(self, lang: str, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tile and cell in it of every pair."""
        rows, columns = self.left.get(lang, self.ONE), self.right.get(lang, self.ONE)
        i = np.searchsorted(rows, left, "right") - 1
        j = np.searchsorted(columns, right, "right") - 1
        width = np.append(columns[1:], self.width(lang)) - columns
        return i * len(columns) + j, (left - rows[i]) * width[j] + right - columns[j]

    def width(self, lang: str) -> int:
        """More than any right id: of languages in one band only the order matters, so a power of two serves."""
        return self.sizes.get(lang, 1 << 31)

    def cells(self, lang: str, tile: int) -> int:
        """Cells of a tile, if all its bands end within the grid."""
        rows, columns = self.left.get(lang, self.ONE), self.right.get(lang, self.ONE)
        i, j = divmod(tile, len(columns))
        if i + 1 >= len(rows) or (j + 1 >= len(columns) and lang not in self.sizes):
            return 0
        end = columns[j + 1] if j + 1 < len(columns) else self.width(lang)
        return int((rows[i + 1] - rows[i]) * (end - columns[j]))

    def pairs(self, lang: str, tile: int, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Left and right ids of cells of a tile."""
        rows, columns = self.left.get(lang, self.ONE), self.right.get(lang, self.ONE)
        i, j = divmod(tile, len(columns))
        width = (columns[j + 1] if j + 1 < len(columns) else self.width(lang)) - columns[j]
        return rows[i] + cells // width, columns[j] + cells % width


def counted(cells: np.ndarray, size: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells, ascending, and their counts: dense where the tile is narrow and well filled, else sorted."""
    if 0 < size <= most and len(cells) * 16 >= size:
        counts = np.bincount(cells, minlength=size)
        at = np.flatnonzero(counts)
        return at, counts[at]
    return np.unique(cells, return_counts=True)


class Sums:
    """Sums of partial counts of one tile: a dense array, or sorted cells that are merged as they double."""

    def __init__(self, size: int, most: int):
        self.dense = np.zeros(size, np.int64) if 0 < size <= most else None
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = self.merged = 0

    def add(self, cells: np.ndarray, counts: np.ndarray) -> None:
        if self.dense is not None:
            self.dense[cells] += counts
            return
        self.parts.append((cells, counts))
        self.waiting += len(cells)
        if self.waiting > max(1 << 20, self.merged):
            self.merge()

    def merge(self) -> None:
        cells = np.concatenate([c for c, _ in self.parts])
        counts = np.concatenate([n for _, n in self.parts])
        order = np.argsort(cells, kind="stable")
        cells, counts = cells[order], counts[order]
        first = np.flatnonzero(np.append(True, np.diff(cells) > 0)) if len(cells) else np.zeros(0, np.int64)
        self.parts = [(cells[first], np.add.reduceat(counts, first) if len(first) else counts)]
        self.merged, self.waiting = len(first), 0

    def frequent(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        if self.dense is not None:
            at = np.flatnonzero(self.dense >= least)
            return at, self.dense[at]
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.merge()
        cells, counts = self.parts[0]
        return cells[counts >= least], counts[counts >= least]


def arrow(schema: str, columns: dict) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[n], kinds[k]) for n, k in fields], [n for n, _ in fields])


def frequent_pairs(streams: DataFrame, grid: Grid, longer: int, least: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (left item, following word) found at least ``least`` times, and the cells that each block has.

    A block sends the distinct cells of each tile with their counts, so one tile gets a cell once from a block however
    often the pair occurs. Tiles are summed one after another from sorted rows: a task holds one tile's sums.
    """
    sent = "lang string, tile bigint, block bigint, cells binary, counts binary"

    def tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k].as_py() for n in ("block", "lang", "left", "word")}
                left, word = unpack(row["left"]), unpack(row["word"])
                runs = max(0, len(left) - longer)
                left, following, word = left[:runs], left[1 : runs + 1], word[longer:]
                # a frequent run begins with a frequent run and ends with one
                ok = (left >= 0) & (word >= 0) & (following >= 0)
                tile, cell = grid.place(row["lang"], left[ok], word[ok])
                order = np.argsort(tile, kind="stable")
                tile, cell = tile[order], cell[order]
                edges = np.flatnonzero(np.append(True, np.diff(tile) > 0)) if len(tile) else np.zeros(0, np.int64)
                out: dict[str, list] = {n: [] for n in ("lang", "tile", "block", "cells", "counts")}
                for a, b in zip(edges, np.append(edges[1:], len(tile))):
                    cells, counts = counted(cell[a:b], grid.cells(row["lang"], int(tile[a])), most)
                    for n, v in zip(out, (row["lang"], int(tile[a]), row["block"], pack(cells), pack(counts))):
                        out[n].append(v)
                yield arrow(sent, out)

    found = "lang string, left bigint, right bigint, a bigint"

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None

        def done() -> Iterator[pa.RecordBatch]:
            if key is not None:
                cells, counts = total.frequent(least)
                left, right = grid.pairs(*key, cells)
                yield arrow(found, {"lang": [key[0]] * len(cells), "left": left, "right": right, "a": counts})

        for batch in batches:
            for lang, tile, cells, counts in zip(*(batch.column(n).to_pylist() for n in ("lang", "tile", "cells", "counts"))):
                if key != (lang, tile):
                    yield from done()
                    key, total = (lang, tile), Sums(grid.cells(lang, tile), most)
                total.add(unpack(cells), unpack(counts))
        yield from done()

    partial = written(streams.mapInArrow(tiles, sent), "tiles")
    rows = partial.drop("block").repartition("lang", "tile").sortWithinPartitions("lang", "tile")
    return written(rows.mapInArrow(sums, found), "pairs"), partial


def marked(streams: DataFrame, partial: DataFrame, pairs: DataFrame, grid: Grid, longer: int) -> DataFrame:
    """The streams with the ids of the ranked pairs as ``left``.

    Pairs and blocks meet at their tile: its pairs come first in sorted order and stay in memory while each block's
    cells pass; a block gets back those of its cells that are frequent, with their ids.
    """
    asked = "lang string, tile bigint, block bigint, cell bigint, id bigint, cells binary"

    def addresses(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            left, right, ids = (np.asarray(batch.column(n)) for n in ("left", "right", "id"))
            for lang in dict.fromkeys(langs):
                own = langs == lang
                tile, cell = grid.place(lang, left[own], right[own])
                n = len(tile)
                yield arrow(asked, {"lang": [lang] * n, "tile": tile, "block": np.full(n, -1), "cell": cell, "id": ids[own], "cells": [None] * n})

    told = "block bigint, lefts binary, rights binary, ids binary"

    def answers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, cells, ids = None, [], None, None
        for batch in batches:
            table = batch.to_pydict()
            for k in range(batch.num_rows):
                here = (table["lang"][k], table["tile"][k])
                if here != key:
                    key, parts, cells = here, [], None
                if table["block"][k] < 0:
                    parts.append((table["cell"][k], table["id"][k]))
                    continue
                if not parts:
                    continue
                if cells is None:
                    known = np.array(parts, np.int64)
                    order = np.argsort(known[:, 0])
                    cells, ids = known[order, 0], known[order, 1]
                mine = unpack(table["cells"][k])
                at = np.minimum(np.searchsorted(cells, mine), len(cells) - 1)
                hit = cells[at] == mine
                if hit.any():
                    left, right = grid.pairs(*key, mine[hit])
                    yield arrow(told, {"block": [table["block"][k]], "lefts": [pack(left)], "rights": [pack(right)], "ids": [pack(ids[at[hit]])]})

    def renamed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                left, word = unpack(row["left"]), unpack(row["word"])
                new = np.full(len(left), -1, np.int64)
                told_left = np.concatenate([unpack(r["lefts"]) for r in row["told"]])
                told_right = np.concatenate([unpack(r["rights"]) for r in row["told"]])
                ids = np.concatenate([unpack(r["ids"]) for r in row["told"]])
                width = int(told_right.max()) + 1
                names = told_left * width + told_right
                order = np.argsort(names)
                names, ids = names[order], ids[order]
                ok = np.flatnonzero((left[: max(0, len(left) - longer)] >= 0) & (word[longer:] >= 0) & (word[longer:] < width))
                mine = left[ok] * width + word[ok + longer]
                at = np.minimum(np.searchsorted(names, mine), len(names) - 1)
                hit = names[at] == mine
                new[ok[hit]] = ids[at[hit]]
                yield arrow("block bigint, lang string, left binary, word binary", {"block": [row["block"]], "lang": [row["lang"]], "left": [pack(new)], "word": [row["word"]]})

    listed = pairs.select("lang", "left", "right", "id").mapInArrow(addresses, asked)
    cells = partial.select("lang", "tile", "block", F.lit(None).cast("bigint").alias("cell"), F.lit(None).cast("bigint").alias("id"), "cells")
    met = listed.unionByName(cells).repartition("lang", "tile").sortWithinPartitions("lang", "tile", "block")
    replies = met.mapInArrow(answers, told).groupBy("block").agg(F.collect_list(F.struct("lefts", "rights", "ids")).alias("told"))
    return written(streams.join(replies, "block").mapInArrow(renamed, "block bigint, lang string, left binary, word binary"), "streams")


def word_streams(blocks: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Every block with its words as vocabulary ids; other words and breaks are -1."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                known = batch.column("known")[k].values
                stream = unpack(batch.column("stream")[k].as_py())
                names = np.full(max(2, int(stream.max(initial=0)) + 2), -1, np.int64)  # the last place serves the breaks
                names[np.asarray(known.field("pos"))] = np.asarray(known.field("id"))
                ids = pack(squeezed(names[stream]))
                columns = {"block": [batch.column("block")[k].as_py()], "lang": [batch.column("lang")[k].as_py()], "left": [ids], "word": [ids]}
                yield arrow("block bigint, lang string, left binary, word binary", columns)

    words = blocks.select("block", "lang", F.posexplode("words").alias("pos", "word"))
    known = lookup_join(words, vocabulary.select("lang", "word", "id"), ["lang", "word"], salt_on=["block"])
    known = known.groupBy("block").agg(F.collect_list(F.struct("pos", "id")).alias("known"))
    rows = blocks.select("block", "lang", "stream").join(known, "block")
    return written(rows.mapInArrow(run, "block bigint, lang string, left binary, word binary"), "streams")


def frequencies(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, block: int = BLOCK, tile: int = TILE, cells: int = CELLS
) -> tuple[DataFrame, DataFrame]:
    """Occurrences of every run of up to ``longest`` words that is found at least ``least`` times in its language.

    Returns (lang, phrase, words, f) and (lang, n), the occurrences of all words. ``block``, ``tile`` and ``cells`` steer
    the work, not the result.
    """
    blocks = blocks_of(docs, text, lang, block)
    totals = written(blocks.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    words = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    words = words.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("a")).where(F.col("a") >= least)
    vocabulary = written(ranked(words, ["word"], "words"), "vocabulary")
    phrases = [vocabulary.select("lang", "id", F.col("word").alias("phrase"), F.lit(1).alias("words"), F.col("a").alias("f"))]
    streams = word_streams(blocks, vocabulary)
    columns = bands_of(vocabulary, tile)
    sizes = {r["lang"]: r["n"] for r in vocabulary.where(F.col("lang").isin(list(columns))).groupBy("lang").agg((F.max("id") + 1).alias("n")).collect()}
    rows = columns
    for n in range(2, longest + 1):
        grid = Grid(rows, columns, sizes)
        pairs, partial = frequent_pairs(streams, grid, n - 1, least, cells)
        level = written(ranked(pairs, ["left", "right"], "ranks"), "level")
        ends = phrases[0].select("lang", F.col("id").alias("right"), F.col("phrase").alias("_last"))
        begins = phrases[-1].select("lang", F.col("id").alias("left"), F.col("phrase").alias("_first"))
        named = level.join(begins, ["lang", "left"]).join(ends, ["lang", "right"])
        phrase = F.concat_ws(" ", "_first", "_last").alias("phrase")
        phrases.append(written(named.select("lang", "id", phrase, F.lit(n).alias("words"), F.col("a").alias("f")), "phrases"))
        if n < longest:
            streams = marked(streams, partial, level, grid, n - 1)
            rows = bands_of(level, tile)
    every = phrases[0]
    for more in phrases[1:]:
        every = every.unionByName(more)
    return every.drop("id"), totals


def ordered_first(rows: DataFrame, most: int, shards: int = 64) -> DataFrame:
    """The first ``most`` rows of every language with their rank: first within shards, then among those that stay."""
    order = "score DESC, a DESC, phrase ASC"
    part = rows.selectExpr("*", f"pmod(xxhash64(phrase), {shards}) AS _shard")
    part = part.selectExpr("*", f"row_number() OVER (PARTITION BY lang, _shard ORDER BY {order}) AS _rn").where(f"_rn <= {most}")
    return part.drop("_shard", "_rn").selectExpr("*", f"CAST(row_number() OVER (PARTITION BY lang ORDER BY {order}) AS BIGINT) AS rank").where(f"rank <= {most}")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, covered: int = COVERED, most: int = MOST, **work
) -> DataFrame:
    """The first ``most`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?]`` and line ends, and pieces into words at spaces and tabs.
    A candidate has 2 to ``longest`` words and a >= ``least`` occurrences inside pieces, overlaps included. Of its cuts
    into a first part (l occurrences) and the rest (r) the one with the lowest floor(2000000 a / (l + r)) counts, at
    equal scores the earliest. A candidate inside a longer one that has ``covered`` per cent of its occurrences is left
    out. Rows go by score and occurrences, both descending, then by the phrase's bytes. n counts the words of the language.
    A null text has no words, a null language is ``und``; repeated rows count as often as they occur; other columns play
    no part; an empty table gives no rows. ``work`` may hold the sizes of ``frequencies``.
    """
    every, totals = frequencies(docs, text, lang, least, longest, **work)
    exact = "decimal(38,0)"
    candidates = every.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    split = F.split("phrase", " ", -1)
    cuts = candidates.select("lang", "phrase", "a", split.alias("_w"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("_w", F.lit(1), F.col("k")), " ").alias("_l"),
        F.array_join(F.slice("_w", F.col("k") + 1, F.size("_w")), " ").alias("_r"),
    )
    cuts = cuts.join(every.select("lang", F.col("phrase").alias("_l"), F.col("f").alias("l")), ["lang", "_l"])
    cuts = cuts.join(every.select("lang", F.col("phrase").alias("_r"), F.col("f").alias("r")), ["lang", "_r"])
    score = F.expr(f"CAST(CAST({SCALE} AS {exact}) * CAST(a AS {exact}) AS {exact}) div CAST(CAST(l AS {exact}) + CAST(r AS {exact}) AS {exact})")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    best = best.select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    inner = candidates.where("words > 2").select("lang", F.col("a").alias("_longer"), split.alias("_w"), "words")
    inner = inner.select("lang", "_longer", "_w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("_n"))
    inner = inner.select("lang", "_longer", "_w", "_n", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("_n") + 1)).alias("_i"))
    inner = inner.groupBy("lang", F.array_join(F.slice("_w", F.col("_i"), F.col("_n")), " ").alias("phrase")).agg(F.max("_longer").alias("_longer"))
    inside = (F.lit(100).cast(exact) * F.col("_longer").cast(exact)) >= (F.lit(covered).cast(exact) * F.col("a").cast(exact))
    open_ = best.join(inner, ["lang", "phrase"], "left").where(F.col("_longer").isNull() | ~inside).drop("_longer")
    top = ordered_first(open_, most)
    return lookup_join(top, totals, ["lang"], salt_on=["phrase"]).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{folder}/documents.parquet"))


SQL = r"""
WITH p AS (
  SELECT lang, row_number() OVER () AS piece, words FROM (
    SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words FROM (
      SELECT coalesce(lang, 'und') AS lang,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
    )
  ) WHERE len(words) > 0
), t AS (SELECT lang, sum(len(words))::BIGINT AS n FROM p GROUP BY lang),
g AS (
  SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase FROM (
    SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4])::BIGINT AS k) WHERE len(words) >= k
  )
), f AS (SELECT lang, k, phrase, count(*)::BIGINT AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (SELECT *, unnest(range(1, k)) AS j FROM c),
s AS (
  SELECT cut.lang, cut.phrase, cut.a, j, x.f AS l, y.f AS r, ((2000000::HUGEINT * cut.a::HUGEINT) // (x.f::HUGEINT + y.f::HUGEINT))::BIGINT AS score FROM cut
  JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(cut.w[1 : j], ' ')
  JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(cut.w[j + 1 : cut.k], ' ')
), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
i AS (
  SELECT lang, sub AS phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(w[i : i + m - 1], ' ') AS sub FROM (
      SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)
    )
  ) GROUP BY ALL
), o AS (
  SELECT b.* FROM b LEFT JOIN i USING (lang, phrase)
  WHERE i.longer IS NULL OR 100::HUGEINT * i.longer::HUGEINT < 80::HUGEINT * b.a::HUGEINT
), k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, t.n, k.score FROM k JOIN t USING (lang) WHERE k.rank <= 2000
"""
