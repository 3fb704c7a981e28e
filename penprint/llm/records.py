"""Token ids in length-delimited binary record files, with an offset index beside each file.

A record file holds records one after another: the payload's length (u64), the masked checksum of those eight bytes
(u32), the payload, and the masked checksum of the payload (u32), all little-endian. The checksum is zlib's CRC-32,
rotated and offset like the checksums of the well-known length-delimited training formats so that a checksum stored in
a payload is not mistaken for a frame's. A payload is the document id (i64; the null flag is in the next field), flags
(u8: 1 null id), bytes per token id (u8: 2 or 4), and the ids. The index file has three i64 per record: the frame's
offset, its length, and the number of ids, so that records can be read in any order with one seek each.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from penprint.llm.common import bounded, shared_folder

END = 0
CACHE = 200_000  # pieces whose ids a worker keeps, about 0.04 GB
MANIFEST = "part int, file string, docs bigint, tokens bigint, bytes bigint"

HEAD, FRAME, INDEX = "<qBB", "<QI", "<qqq"  # of a payload, a frame, an index entry
ODD, CUT = re.compile(r" (?!\S)"), re.compile(r" (?=\S)")
LETTERS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-@\[-`{-~].*)", re.DOTALL)  # a run of letters ends before these marks for any tokenizer of this kind


def masked(data: bytes) -> int:
    """CRC-32, rotated right by 15 bits plus a constant."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def unframe(data: bytes | memoryview, at: int) -> tuple[bytes, int]:
    """The payload of the frame that begins at ``at`` and the place after it; a wrong checksum raises."""
    length, check = struct.unpack_from(FRAME, data, at)
    if masked(bytes(data[at : at + 8])) != check:
        raise ValueError("a record's length does not match its checksum")
    begin = at + struct.calcsize(FRAME)
    payload = bytes(data[begin : begin + length])
    if struct.unpack_from("<I", data, begin + length)[0] != masked(payload):
        raise ValueError("a record does not match its checksum")
    return payload, begin + length + 4


class Encoder:
    """Whole texts to ids with a tokenizer of the tokenizers library.

    Byte-level tokenizers never join a word to the space in front of the next one, so the ids of a text are the ids of
    its pieces between spaces. Pieces repeat, so their ids are kept, up to ``CACHE`` pieces; the library encodes those
    not seen before. When there is no more room, the half that was met first stays, as frequent pieces are met early, and
    the rest makes room for others. Other tokenizers encode every text as it is.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        state = __import__("json").loads(definition)
        before = state.get("pre_tokenizer") or {}
        self.pieced = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not state.get("normalizer")
        line = self.ids(["\n"])[0] if self.pieced else ()
        self.line = line[0] if len(line) == 1 else None
        self.seen: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.latest: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, pieces: list[str]) -> None:
        """Encode new pieces with the space in front of them, letters and what follows them apart, and keep their ids."""
        if len(self.seen) + len(pieces) > CACHE:
            self.seen = dict(islice(self.seen.items(), CACHE // 2))
            self.tails = dict(islice(self.tails.items(), CACHE // 8))
        split = [(p, *m.groups()) for p in pieces if (m := LETTERS.fullmatch(p))] if self.line is not None else []
        tails = list({tail for _, _, tail in split if tail not in self.tails})
        self.tails.update((t, np.array(i, self.kind).tobytes()) for t, i in zip(tails, self.ids(tails)))
        plain = set(pieces).difference([p for p, _, _ in split])
        words = {word for _, word, _ in split if word not in self.seen}
        self.latest = self.whole(list(plain | words))
        self.seen.update(self.latest)
        for piece, word, tail in split:
            self.latest[piece] = self.seen[word] + self.tails[tail]
        self.seen.update(self.latest)

    def whole(self, pieces: list[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        plain = [p for p in pieces if self.line is not None and "\n" not in p and ODD.search(" " + p) is None]
        for k in range(0, len(plain), 500):  # many pieces in one call, one on each line
            part = plain[k : k + 500]
            ids = np.array(self.ids([" " + "\n ".join(part)])[0], self.kind)
            ends = np.flatnonzero(ids == self.line)
            if len(ends) != len(part) - 1:
                raise ValueError("the tokenizer joins words across lines")
            size = self.kind.itemsize
            data, bounds = ids.tobytes(), [0, *((ends + 1) * size).tolist(), len(ids) * size + size]
            out.update((piece, data[bounds[i] : bounds[i + 1] - size]) for i, piece in enumerate(part))
        if len(plain) < len(pieces):
            rest = list(set(pieces).difference(plain))
            out.update((p, np.array(i, self.kind).tobytes()) for p, i in zip(rest, self.ids([" " + p for p in rest])))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.pieced:
            return [np.array(i, self.kind).tobytes() for i in self.ids(texts)]
        cut = [text.split(" ") if ODD.search(text) is None else CUT.split(text) for text in texts]
        first = [np.array(i, self.kind).tobytes() for i in self.ids([pieces.pop(0) for pieces in cut])]
        get = self.seen.get
        found = [list(map(get, pieces)) for pieces in cut]
        gaps = [i for i, ids in enumerate(found) if None in ids]
        missing = list({p for i in gaps for p, x in zip(cut[i], found[i]) if x is None})
        if missing:
            self.learn(missing)
            new = self.latest
            for i in gaps:
                found[i] = [new[p] if x is None else x for p, x in zip(cut[i], found[i])]
        return [head + b"".join(ids) for head, ids in zip(first, found)]


_encoders: dict[int, Encoder] = {}


def encoder(definition: str) -> Encoder:
    """One encoder per worker and tokenizer."""
    key = hash(definition)
    if key not in _encoders:
        _encoders[key] = Encoder(definition)
    return _encoders[key]


def store(folder: str):
    """The file system of a folder and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


def write_records(docs: DataFrame, folder: str, tokenizer: str, end: int | None = END, identity: str = "doc_id") -> DataFrame:
    """Encode every text, append ``end``, and write record and index files in ascending order of the id.

    One pair of files per range of ids; rows that share an id are put in order by a hash of their text, null ids come
    first, null texts count as empty (their record holds the end id alone). A task that runs twice writes other files;
    only the files named in the returned manifest (part, file, docs, tokens, bytes) belong to the result, which is
    itself kept beside them. An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as source:
        definition = spark.sparkContext.broadcast(source.read())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, files, target = encoder(definition.value), None, store(folder)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        kind, count, tokens, at = coder.kind, 0, 0, 0
        tail = b"" if end is None else np.array([end], kind).tobytes()
        for batch in bounded(batches, 1 << 20):
            if files is None:
                target[0].create_dir(target[1], recursive=True)
                files = [target[0].open_output_stream(f"{target[1]}/{name}.{x}") for x in ("rec", "idx")]
            texts = [t or "" for t in batch.column("text").to_pylist()]
            frames, index = [], []
            for key, ids in zip(batch.column("id").to_pylist(), coder.encode(texts)):
                data = frame(struct.pack(HEAD, key or 0, key is None, kind.itemsize) + ids + tail)
                n = (len(ids) + len(tail)) // kind.itemsize
                frames.append(data)
                index.append(struct.pack(INDEX, at, len(data), n))
                at, tokens, count = at + len(data), tokens + n, count + 1
            files[0].write(b"".join(frames))
            files[1].write(b"".join(index))
        if files:
            for f in files:
                f.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "file": [name], "docs": [count], "tokens": [tokens], "bytes": [at]}
            )

    rows = docs.select(F.col(identity).cast("bigint").alias("id"), "text").withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def decoded(payload: bytes) -> tuple[int | None, np.ndarray]:
    key, null, width = struct.unpack_from(HEAD, payload)
    return None if null else key, np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(HEAD)).astype("<u4")


def read_records(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """All records of a folder, checked against their checksums, one task per file.

    Returns doc_id, start (ids in the records before it), n_tokens, ids_crc32 (of the ids as little-endian u32), and
    the ids themselves in that form unless they are not wanted.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    starts = manifest.withColumn("begin", F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens"))  # a row per file
    files = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                before, rest = row["begin"], b""
                with system.open_input_stream(f"{root}/{row['file']}.rec") as source:
                    while True:
                        more = source.read(4 << 20)
                        data, at, out = rest + more, 0, []
                        while at + struct.calcsize(FRAME) <= len(data) and at + struct.calcsize(FRAME) + struct.unpack_from(FRAME, data, at)[0] + 4 <= len(data):
                            payload, at = unframe(data, at)
                            key, ids = decoded(payload)
                            raw = ids.tobytes()
                            out.append((key, before, len(ids), zlib.crc32(raw), raw if with_ids else None))
                            before += len(ids)
                        rest = data[at:]
                        if out:
                            columns = list(zip(*out))
                            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
                            )
                        if not more:
                            break
                    if rest or before != row["begin"] + row["tokens"]:
                        raise ValueError(f"{row['file']} does not hold what its manifest says")

    spread = starts.select("file", "begin", "tokens").repartition(files)
    found = spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary")
    return found if with_ids else found.drop("ids")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The offset index of all files: file, offset, length, n_tokens."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with system.open_input_stream(f"{root}/{name}.idx") as source:
                    while data := source.read(struct.calcsize(INDEX) << 16):
                        table = np.frombuffer(data, "<i8").reshape(-1, 3)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(table)), *(pa.array(table[:, k].copy()) for k in range(3))], ["file", "offset", "length", "n_tokens"]
                        )

    return manifest.select("file").repartition(max(1, manifest.count())).mapInArrow(
        read, "file string, offset bigint, length bigint, n_tokens bigint"
    )


def read_shuffled(spark: SparkSession, folder: str, seed: int = 0) -> DataFrame:
    """Records in an order drawn from a hash of seed and place: the index is shuffled, then each record is sought.

    Returns shuffled (the hash that orders them), doc_id, n_tokens, ids. Within a partition the rows are in order.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store(folder)
        open_files: dict = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                out = []
                for row in batch.slice(lo, 256).to_pylist():
                    if row["file"] not in open_files:
                        open_files[row["file"]] = system.open_input_file(f"{root}/{row['file']}.rec")
                    source = open_files[row["file"]]
                    source.seek(row["offset"])
                    key, ids = decoded(unframe(source.read(row["length"]), 0)[0])
                    out.append((row["shuffled"], key, len(ids), ids.tobytes()))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["shuffled", "doc_id", "n_tokens", "ids"])

    order: Column = F.xxhash64(F.lit(seed), "file", "offset").alias("shuffled")
    index = read_index(spark, folder).select(order, "file", "offset", "length")
    return index.repartitionByRange("shuffled").sortWithinPartitions("shuffled").mapInArrow(
        read, "shuffled bigint, doc_id bigint, n_tokens bigint, ids binary"
    )


def op2_records(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    target = shared_folder(spark, "records")
    write_records(docs, target, public_tokenizers.path("byte_bpe_50k.json"))
    return read_records(spark, target, with_ids=False)
