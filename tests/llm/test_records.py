import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from penprint.llm import records
from penprint.llm.common import shared_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  ", "a  b", "a   b", "x\n  b", "a \n b", "\n\n a", "don't 's  's we'll", "a\t b \tc", "a　b 　c", "a \x1cb", "a \x85b  ",
    "é è  ê", " lead", "trail ", "a\r\n b", "1 22  333 4\n\n\n 5", "<|endoftext|> x", "\x00 \x1f  \x1d a", "word,word ÿz Ąb ß!", "áb c", "😀 😀😀",
]


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_ids_of_whole_texts(whole, monkeypatch):
    with open(PATH, encoding="utf-8") as source:
        coder = records.Encoder(source.read())
    texts = [*ODD, " ".join(ODD), "Ab,c d.e " * 400]
    for limit in (records.CACHE, 5):
        monkeypatch.setattr(records, "CACHE", limit)
        for part in (texts, texts[::-1], texts[3:7]):
            assert [np.frombuffer(b, coder.kind).tolist() for b in coder.encode(part)] == [whole(t) for t in part]


def test_round_trip_with_odd_rows(spark, whole):
    rows = [(i * 7 % 50, t, "x") for i, t in enumerate(ODD)] + [(3, "same"), (3, "same"), (None, "no id"), (99, None), (100, "long text " * 30000)]
    docs = spark.createDataFrame([(r[0], r[1], 5) for r in rows], "doc_id bigint, text string, tokens int").repartition(4)
    folder = shared_folder(spark, "test-records")
    manifest = records.write_records(docs, folder, PATH)
    assert manifest.agg({"docs": "sum"}).first()[0] == len(rows)
    out = sorted(records.read_records(spark, folder).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in out]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    start, texts = 0, {}
    for r in out:
        values = np.frombuffer(r["ids"], "<u4")
        assert r["start"] == start and r["n_tokens"] == len(values) and r["ids_crc32"] == zlib.crc32(r["ids"]) and values[-1] == 0
        texts.setdefault(r["doc_id"], []).append(values[:-1].tolist())
        start += r["n_tokens"]
    for key in {r[0] for r in rows}:
        assert sorted(texts[key]) == sorted(whole(r[1]) for r in rows if r[0] == key)
    index = records.read_index(spark, folder).collect()
    assert sum(r["n_tokens"] for r in index) == start and len(index) == len(rows)
    shuffled = records.read_shuffled(spark, folder, seed=3).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"], r["ids"]) for r in shuffled) == sorted((r["doc_id"] is not None, r["doc_id"], r["ids"]) for r in out)


def test_frames_notice_damage_and_empty_tables_are_empty(spark):
    data = records.frame(b"payload")
    assert records.unframe(data + b"next", 0) == (b"payload", len(data))
    for place in (0, 9, 13, len(data) - 1):
        with pytest.raises(ValueError):
            records.unframe(data[:place] + bytes([data[place] ^ 1]) + data[place + 1 :], 0)
    folder = shared_folder(spark, "test-records")
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert records.write_records(empty, folder, PATH).count() == 0
    assert records.read_records(spark, folder).count() == 0 and records.read_shuffled(spark, folder).count() == 0


def test_query_covers_every_document(spark, small, whole):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    start = 0
    for r in sorted(records.op2_records(spark, small).collect()):
        ids = np.array([*whole(texts.pop(r["doc_id"])), 0], "<u4")
        assert tuple(r)[1:] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not texts


def test_a_full_cache_keeps_the_pieces_met_first(whole, monkeypatch):
    monkeypatch.setattr(records, "CACHE", 40)
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as source:
        coder = records.Encoder(source.read())
    coder.encode(["x " + " ".join(f"first{chr(97 + i)}" for i in range(10))])
    texts = ["x " + " ".join(f"w{k}u{i}" for i in range(15)) for k in range(12)]
    ids = coder.encode(texts[:1])
    for text in texts[1:]:
        ids += coder.encode([text])
        assert len(coder.seen) <= 40
    assert "firsta" in coder.seen and ids == coder.encode(texts)
