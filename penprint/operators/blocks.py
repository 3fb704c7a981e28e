"""Blocks of directions, input columns by components, kept as files of rows cut by input column.

A block is as wide as the input and as deep as the components wanted, so it is never held whole: not on the driver, and not in
a task. Tasks read its files one after another from the checkpoint folder and write those of the next one; the driver sees
matrices of components by components, and the names of the files.

The rows lie in files too, written once for all rounds: chunks of rows, their entries in order of the block's files. One pass
multiplies every chunk by the block and writes its image, a second one sums up a file of the result from the images and the
chunks' entries of those columns, so that no round shuffles.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.session import run_folder

FILE = 8 << 20  # bytes of a file, and of the products held at once
ENTRIES = 1 << 22  # entries of the rows multiplied together
SHORT = 1 << 16  # rows of a chunk and columns of a file at most
GROUP = 4  # files' worth of numbers that a task holds in either pass


def store(folder: str):
    """The file system of a folder and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder.removeprefix("file:"))


@dataclass(frozen=True)
class Block:
    """What the files hold times ``turn``; files that are not listed hold zeros."""

    folder: str
    width: int
    deep: int  # columns of the files
    step: int  # rows of a file
    files: dict
    turn: np.ndarray

    @property
    def numbers(self) -> range:
        return range(-(-self.width // self.step))

    def rows(self, number: int) -> np.ndarray:
        """The rows of a file, not turned."""
        size = min(self.step, self.width - number * self.step)
        if number not in self.files:
            return np.zeros((size, self.deep))
        system, path = store(self.folder)
        with system.open_input_file(f"{path}/{self.files[number]}") as source:
            return np.frombuffer(source.read(), np.float64).reshape(size, self.deep)

    def whole(self) -> np.ndarray:
        """Everything at once, for small blocks."""
        return np.concatenate([self.rows(n) @ self.turn for n in self.numbers]) if self.width else np.zeros((0, self.turn.shape[1]))

    def drop(self) -> None:
        system, path = store(self.folder)
        system.delete_dir(path)


def empty(spark: SparkSession, width: int, deep: int, step: int | None = None) -> Block:
    folder = run_folder(spark, "block")
    system, path = store(folder)
    system.create_dir(path, recursive=True)
    return Block(folder, width, deep, step or max(1, min(SHORT, FILE // (8 * max(deep, 1)))), {}, np.eye(deep))


def save(block: Block, number: int, rows: np.ndarray) -> pa.RecordBatch:
    """Write a file under a name of its own, so that a task that runs twice disturbs nothing; the row that lists it."""
    system, path = store(block.folder)
    name = f"{number:06d}-{uuid.uuid4().hex}"
    with system.open_output_stream(f"{path}/{name}") as target:
        target.write(np.ascontiguousarray(rows, np.float64).tobytes())
    return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([name])], ["number", "file"])


def listed(block: Block, found: DataFrame) -> Block:
    return replace(block, files={r["number"]: r["file"] for r in found.collect()})


def over_files(spark: SparkSession, files: int, schema: str, work: Callable[[Iterator[int]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Run ``work`` in tasks over the numbers of the files, neighbours together."""
    tasks = max(1, min(files, spark.sparkContext.defaultParallelism))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(n for batch in batches for n in batch.column(0).to_pylist())

    return spark.range(0, files, 1, tasks).mapInArrow(run, schema)


def drawn(spark: SparkSession, width: int, deep: int, seed: int) -> Block:
    """Random directions, normal."""
    block = empty(spark, width, deep)

    def draw(numbers: Iterator[int]) -> Iterator[pa.RecordBatch]:
        for n in numbers:
            yield save(block, n, np.random.default_rng([seed, n]).normal(size=(min(block.step, width - n * block.step), deep)))

    return listed(block, over_files(spark, len(block.numbers), "number bigint, file string", draw))


def facts(spark: SparkSession, block: Block, other: Block | None = None, mean: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the files: the triangular factor, the products of the mean with them, and those of ``other``'s files with them."""
    shared = spark.sparkContext.broadcast(mean)

    def work(numbers: Iterator[int]) -> Iterator[pa.RecordBatch]:
        upper, along = np.zeros((0, block.deep)), np.zeros(block.deep)
        cross = np.zeros((other.deep if other else 0, block.deep))
        for n in numbers:
            rows = block.rows(n)
            upper = np.linalg.qr(np.concatenate([upper, rows]), mode="r")
            if shared.value is not None:
                along += shared.value[n * block.step : n * block.step + len(rows)] @ rows
            if other:
                cross += other.rows(n).T @ rows
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (upper, along, cross)], ["upper", "along", "cross"])

    parts = over_files(spark, len(block.numbers), "upper binary, along binary, cross binary", work).collect()
    matrix = lambda r, c: np.frombuffer(r[c], np.float64).reshape(-1, block.deep)
    upper = np.linalg.qr(np.concatenate([matrix(r, "upper") for r in parts]), mode="r")
    return upper, sum(matrix(r, "along")[0] for r in parts), sum(matrix(r, "cross") for r in parts)


def orthonormal(block: Block, upper: np.ndarray) -> Block:
    """The block turned to orthonormal directions of the same span; those that are nothing but rounding are left out."""
    _, values, right = np.linalg.svd(upper)
    kept = values > values[0] * 1e-13 if len(values) and values[0] > 0 else np.zeros(len(values), bool)
    return replace(block, turn=right[: len(values)][kept].T / values[kept])


def entries_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of non-zero entries of every row of (type, indices, values), their columns and their values."""
    kinds = batch.column(0).to_numpy(zero_copy_only=False)
    values, indices = batch.column(2), batch.column(1)
    if not (kinds == 1).any():
        return np.diff(values.offsets.to_numpy()), indices.flatten().to_numpy(), values.flatten().to_numpy()
    lengths, columns, numbers = [], [], []
    for kind, i, x in zip(kinds, indices, values):
        x = x.values.to_numpy()
        at = np.flatnonzero(x) if kind == 1 else i.values.to_numpy()
        lengths.append(len(at))
        columns.append(at)
        numbers.append(x[at] if kind == 1 else x)
    return np.array(lengths), np.concatenate(columns), np.concatenate(numbers)


def plain(df: DataFrame, source: str) -> list:
    vector = F.unwrap_udt(F.col(source))
    return [vector["type"].alias("type"), vector["indices"].alias("indices"), vector["values"].alias("values")]


def summed(keys: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
    """Add rows that lie in order of their keys to the rows of ``out`` these name."""
    if len(keys):
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        out[keys[starts]] += np.add.reduceat(rows, starts, axis=0)


def pieces(columns: np.ndarray, block: Block) -> Iterator[tuple[int, int, int]]:
    """File number, begin and end of runs of entries, in order of their file, whose products are held at once."""
    numbers = columns // block.step
    most = max(1, FILE // (8 * max(block.deep, 1)))
    for n in np.unique(numbers):
        begin, end = np.searchsorted(numbers, [n, n + 1])
        for k in range(begin, end, most):
            yield int(n), k, min(k + most, end)


def images(block: Block, at: np.ndarray, columns: np.ndarray, numbers: np.ndarray, n_rows: int) -> np.ndarray:
    """Rows times the block, from their entries."""
    order = np.argsort(columns // block.step, kind="stable")
    at, columns, numbers = at[order], columns[order], numbers[order]
    out, last, held = np.zeros((n_rows, block.deep)), -1, None
    for n, begin, end in pieces(columns, block):
        if n != last:
            last, held = n, block.rows(n)
        part = slice(begin, end)
        summed(at[part], held[columns[part] - n * block.step] * numbers[part, None], out)
    return out @ block.turn


def gathered(batches: Iterator[pa.RecordBatch], deep: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Entries (row, column, value) of as many rows as are multiplied together, and the number of rows."""
    most = max(1, min(SHORT, 8 * FILE // (8 * max(deep, 1))))
    parts: list = []
    n_rows = size = 0

    def joined():
        lengths, columns, numbers = (np.concatenate(x) for x in zip(*parts))
        return np.repeat(np.arange(len(lengths), dtype=np.int32), lengths), columns, numbers, len(lengths)

    for whole in batches:
        for low in range(0, whole.num_rows, most):
            lengths, columns, numbers = entries_of(whole.slice(low, most))
            parts.append((lengths, columns, numbers))
            n_rows, size = n_rows + len(lengths), size + len(columns)
            if n_rows >= most or size > ENTRIES:
                yield joined()
                parts, n_rows, size = [], 0, 0
    if n_rows:
        yield joined()


@dataclass(frozen=True)
class Rows:
    """The rows of a vector column as files of chunks: what they are cut by, and the name and number of rows of each."""

    folder: str
    width: int
    step: int
    chunks: list

    def drop(self) -> None:
        system, path = store(self.folder)
        system.delete_dir(path)


def narrow(numbers: np.ndarray) -> np.ndarray:
    """The same values in as few bytes as hold them exactly."""
    for kind in (np.uint8, np.float32):
        with np.errstate(invalid="ignore", over="ignore"):
            small = numbers.astype(kind)
        if np.array_equal(small, numbers):
            return small
    return numbers


KINDS = [np.uint8, np.float32, np.float64]


def cut(df: DataFrame, source: str, block: Block) -> Rows:
    """Write the rows in chunks, for products with blocks that are cut like ``block``."""
    spark, deep, files, step = df.sparkSession, block.deep, len(block.numbers), block.step
    folder = empty(spark, 0, 0).folder

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = store(folder)
        for at, columns, numbers, n_rows in gathered(batches, deep):
            place = columns // step
            order = np.argsort(place, kind="stable")
            values = narrow(np.asarray(numbers, np.float64)[order])
            ends = np.searchsorted(place[order], np.arange(files + 1))
            name = uuid.uuid4().hex
            with system.open_output_stream(f"{path}/{name}") as target:
                target.write(np.concatenate([[KINDS.index(values.dtype.type)], ends]).astype(np.int64).tobytes())
                for part in (at[order].astype(np.uint16), (columns[order] % step).astype(np.uint16), values):
                    target.write(part.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n_rows])], ["file", "n"])

    found = df.select(*plain(df, source)).mapInArrow(write, "file string, n bigint").collect()
    return Rows(folder, block.width, step, sorted((r["file"], r["n"]) for r in found))


class Chunk:
    """A chunk's file, open: entries (row, column in the block's file, value) of one file after another."""

    def __init__(self, rows: Rows, number: int):
        system, path = store(rows.folder)
        self.source = system.open_input_file(f"{path}/{rows.chunks[number][0]}")
        files = -(-rows.width // rows.step)
        kind, *ends = np.frombuffer(self.source.read(8 * (files + 2)), np.int64)
        self.kind, self.ends, self.begin = np.dtype(KINDS[kind]), ends, 8 * (files + 2)

    def piece(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        low, high, size, begin, out = self.ends[n], self.ends[n + 1], self.ends[-1], self.begin, []
        for kind in (np.dtype(np.uint16), np.dtype(np.uint16), self.kind):
            self.source.seek(int(begin + low * kind.itemsize))
            out.append(np.frombuffer(self.source.read(int(high - low) * kind.itemsize), kind))
            begin += size * kind.itemsize
        return out[0].astype(np.intp), out[1].astype(np.intp), out[2].astype(np.float64)


def together(numbers: Iterator[int], size: Callable[[int], int]) -> Iterator[list[int]]:
    """Neighbouring numbers whose bytes a task holds at once."""
    some: list[int] = []
    held = 0
    for n in numbers:
        if some and held + size(n) > GROUP * FILE:
            yield some
            some, held = [], 0
        some.append(n)
        held += size(n)
    if some:
        yield some


def multiplied(spark: SparkSession, rows: Rows, block: Block, mean: np.ndarray | None = None, less: np.ndarray | None = None) -> Block:
    """``X' (X B)``, less the outer product of ``mean`` and ``less`` if they are given.

    A chunk's product with the block is written as a file of its own; a task then adds up some files of the result from
    all of those.
    """
    deep = block.turn.shape[1]
    out = empty(spark, block.width, deep, block.step)  # cut as the block, which it is multiplied with
    between = empty(spark, 0, deep)
    shared = spark.sparkContext.broadcast(mean)
    most = max(1, FILE // (8 * max(block.deep, 1)))

    def image(numbers: Iterator[int]) -> Iterator[pa.RecordBatch]:
        for some in together(numbers, lambda c: 8 * block.deep * rows.chunks[c][1]):
            chunks = [Chunk(rows, c) for c in some]
            sums = [np.zeros((rows.chunks[c][1], block.deep)) for c in some]
            for n in block.numbers:
                held = None
                for chunk, total in zip(chunks, sums):
                    at, columns, values = chunk.piece(n)
                    for k in range(0, len(at), most):
                        held = block.rows(n) if held is None else held
                        part = slice(k, k + most)
                        summed(at[part], held[columns[part]] * values[part, None], total)
            for c, total in zip(some, sums):
                yield save(between, c, total @ block.turn)

    images = listed(between, over_files(spark, len(rows.chunks), "number bigint, file string", image)).files

    def add(numbers: Iterator[int]) -> Iterator[pa.RecordBatch]:
        system, path = store(between.folder)
        for some in together(numbers, lambda n: 8 * deep * block.step):
            totals = [np.zeros((min(block.step, block.width - n * block.step), deep)) for n in some]
            for c, (_, n_rows) in enumerate(rows.chunks):
                chunk, held = Chunk(rows, c), None
                for n, total in zip(some, totals):
                    at, columns, values = chunk.piece(n)
                    order = np.argsort(columns.astype(np.uint16), kind="stable")
                    at, columns, values = at[order], columns[order], values[order]
                    for k in range(0, len(at), most):
                        if held is None:
                            with system.open_input_file(f"{path}/{images[c]}") as source:
                                held = np.frombuffer(source.read(), np.float64).reshape(n_rows, deep)
                        part = slice(k, k + most)
                        summed(columns[part], held[at[part]] * values[part, None], total)
            for n, total in zip(some, totals):
                if shared.value is not None:
                    total -= np.outer(shared.value[n * block.step : n * block.step + len(total)], less)
                yield save(out, n, total)

    out = listed(out, over_files(spark, len(out.numbers), "number bigint, file string", add))
    between.drop()
    return out


def products(df: DataFrame, source: str, block: Block, mean: np.ndarray | None = None, less: np.ndarray | None = None) -> Block:
    """``X' (X B)`` over the rows of a vector column, see ``multiplied``."""
    rows = cut(df, source, block)
    out = multiplied(df.sparkSession, rows, block, mean, less)
    rows.drop()
    return out


def leading(df: DataFrame, source: str, width: int, size: int, rounds: int, seed: int) -> tuple[Block, np.ndarray]:
    """Orthonormal directions and the eigenvalues of ``X' X`` among them, largest first, by block power iteration."""
    spark = df.sparkSession
    block = drawn(spark, width, size, seed)
    chunks = cut(df, source, block)
    block = orthonormal(block, facts(spark, block)[0])
    for _ in range(rounds):
        image = multiplied(spark, chunks, block)
        turned = orthonormal(image, facts(spark, image)[0])
        if not turned.turn.shape[1]:  # rows of zeros
            image.drop()
            break
        block.drop()
        block = turned
    image = multiplied(spark, chunks, block)
    cross = block.turn.T @ facts(spark, image, block)[2]
    image.drop()
    chunks.drop()
    values, turn = np.linalg.eigh((cross + cross.T) / 2)
    order = np.argsort(-values, kind="stable")
    return replace(block, turn=block.turn @ turn[:, order]), np.maximum(values[order], 0.0)


def signed(spark: SparkSession, block: Block) -> Block:
    """The block with the largest number of each direction positive; of equally large ones the first counts."""
    deep = block.turn.shape[1]

    def work(numbers: Iterator[int]) -> Iterator[pa.RecordBatch]:
        best = np.zeros(deep)
        for n in numbers:
            rows = block.rows(n) @ block.turn
            found = rows[np.abs(rows).argmax(axis=0), np.arange(deep)]
            best = np.where(np.abs(found) > np.abs(best), found, best)
        yield pa.RecordBatch.from_arrays([pa.array([best.tobytes()], pa.binary())], ["best"])

    best = np.zeros(deep)
    for r in over_files(spark, len(block.numbers), "best binary", work).collect():
        found = np.frombuffer(r["best"], np.float64)
        best = np.where(np.abs(found) > np.abs(best), found, best)
    return replace(block, turn=block.turn * np.where(best < 0, -1.0, 1.0))


def as_table(spark: SparkSession, block: Block) -> DataFrame:
    """(row, numbers) of the block, turned."""

    def work(numbers: Iterator[int]) -> Iterator[pa.RecordBatch]:
        for n in numbers:
            rows = block.rows(n) @ block.turn
            at = pa.array(np.arange(len(rows), dtype=np.int32) + n * block.step, pa.int32())
            ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
            yield pa.RecordBatch.from_arrays([at, pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))], ["row", "numbers"])

    return over_files(spark, len(block.numbers), "row int, numbers array<double>", work)


def of_table(table: DataFrame, deep: int) -> Block:
    """The block of ``as_table``."""
    spark = table.sparkSession
    width = (table.agg(F.max("row")).first()[0] or 0) + 1 if deep else 0
    out = empty(spark, width, deep)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = -1, None
        for batch in batches:
            found = batch.column(1).flatten().to_numpy().reshape(-1, deep)
            at = batch.column(0).to_numpy()
            for n in np.unique(at // out.step):
                if n != last:
                    if total is not None:
                        yield save(out, last, total)
                    last, total = int(n), np.zeros((min(out.step, width - int(n) * out.step), deep))
                here = at // out.step == n
                total[at[here] - last * out.step] = found[here]
        if total is not None:
            yield save(out, last, total)

    together = table.repartition(F.floor(F.col("row") / out.step)).sortWithinPartitions("row")
    return listed(out, together.select("row", "numbers").mapInArrow(work, "number bigint, file string"))
