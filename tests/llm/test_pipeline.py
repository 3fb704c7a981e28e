import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from penprint.llm import decontaminate, mixing, near, toxicity
from penprint.llm.common import written


def test_stages_and_run(spark, small):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_records"]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, small), name)
        assert docs.columns == corpus_pipeline.COLUMNS
        old, new = ({r["doc_id"]: r for r in x.collect()} for x in (before, docs))
        assert all(old[i] == r for i, r in new.items())  # kept rows do not change
        seen[name] = (before, old, new)
    before, old, new = seen["toxicity"]
    model = toxicity.fit(before, spark.read.parquet(f"{small}/labels.parquet"))
    score = {r["doc_id"]: r["s"] for r in toxicity.scored(before, model, "s").collect()}
    assert set(new) == {i for i in old if score[i] < toxicity.THRESHOLD} and 0 < len(new) < len(old)
    before, old, new = seen["near_duplicates"]
    assert set(new) == {r["id"] for r in near.near_duplicates(before).collect() if r["kept"]} and len(new) < len(old)
    before, old, new = seen["decontamination"]
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    leaks = {r["doc_id"] for r in decontaminate.with_leaks(before, items).collect() if r["leaks"]}
    assert set(new) == set(old) - leaks
    before, old, new = seen["mixing"]
    copies = {r["doc_id"]: r["mix_copies"] for r in mixing.planned(before).collect()}
    assert {r["doc_id"]: r["count"] for r in docs.groupBy("doc_id").count().collect()} == {i: n for i, n in copies.items() if n}
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    want = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = sorted(map(tuple, corpus_pipeline.run(spark, small).collect()), key=lambda r: r[1])
    assert len(got) == len(want)
    for (i, text), row in zip(want, got):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert row == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_empty_documents(spark, small, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{small}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
