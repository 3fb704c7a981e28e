import random
import re

from pyspark.sql import functions as F

from penprint.operators import chunking

TEXT = (
    "123456789012Это пример текста, который будет использоваться в тесте. Текст содержит более 1000 символов, "
    "чтобы можно было проверить, правильно ли функция разбивает текст на части."
)


def expected(text, size):
    """Plain Python version of the rule, for comparison."""
    tokens = re.findall(r"\w+(?:-\w+)*|\.{3}|[^\w\s]", text)
    out, current = [], ""
    for token in tokens:
        current += token + " "
        if len(current) >= size:
            last = max(current.rfind(c) for c in ".,!?")
            out.append((current[: last + 1] if last >= 0 else current).strip())
            current = ""
    return out + ([current.strip()] if current else [])


def test_fixture(spark):
    books = spark.createDataFrame([("b", TEXT)], "book string, value string")
    rows = chunking.build_corpus(books, 100).orderBy("pos").collect()
    assert len(rows) == 2 and {r["target"] for r in rows} == {"123456789012"}
    assert rows[0]["text"].startswith("Это пример текста")


def test_against_plain_python(spark):
    rng = random.Random(5)
    marks = ["", "", "", ".", ",", "!", "?", "...", ";"]
    texts = [
        " ".join("".join(rng.choice("абвгд-") for _ in range(rng.randint(1, 9))).strip("-") + rng.choice(marks) for _ in range(n))
        for n in (0, 1, 7, 60, 400, 3000)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc int, text string")
    for size in (1, 20, 150, 1000):
        got = {}
        for r in chunking.split_fragments(df.repartition(3), size).collect():
            got.setdefault(r["doc"], []).append((r["pos"], r["text"]))
        for doc, text in enumerate(texts):
            assert [t for _, t in sorted(got.get(doc, []))] == expected(text, size)


def test_token_units_and_long_book(spark):
    df = spark.createDataFrame([(0, "а б в г д")], "doc int, text string")
    rows = chunking.split_fragments(df, 2, unit="tokens").orderBy("pos").collect()
    assert [r["text"] for r in rows] == ["а б", "в г", "д"]
    long = spark.range(1).select("id", F.repeat(F.lit("слово, "), 300_000).alias("text"))
    assert chunking.split_fragments(long, 3000).count() == 800
