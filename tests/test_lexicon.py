import pytest
from pyspark.sql import functions as F

from penprint.functions import text as T
from penprint.operators import lexicon, pos, recipes, scale

LEXICON = [
    ("мама", "мама", "S", "S,жен,од=им,ед"), ("мыла", "мыть", "V", "V,несов,пе=прош,ед,изъяв,жен"),
    ("раму", "рама", "S", "S,жен,неод=вин,ед"), ("папе", "папа", "S", "S,муж,од=(пр,ед|дат,ед)"),
    ("карандаш", "карандаш", "S", "S,муж,неод=(вин,ед|им,ед)"), ("двадцать-два", "двадцать-два", "NUM", "NUM=(вин|им)"),
    ("мир", "мир", "S", "S=им"), ("привет", "привет", "V", "V=x"),
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(LEXICON, "form string, lemma string, tag string, gr string")


@pytest.fixture(params=["broadcast", "salted"])
def joins(request, monkeypatch):
    if request.param == "salted":
        monkeypatch.setattr(scale, "BROADCAST_ROWS", 0)


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "doc int, text string")


def codes(df, table, **options):
    return [r["codes"] for r in lexicon.grammar_codes(df, table, "doc", **options).orderBy("doc").collect()]


def test_grammar_codes(spark, table, joins):
    df = texts(spark, "Мама. Мыла раму папе", "", "неизвестное!")
    full = "S,жен,од=им,ед PNT V,несов,пе=прош,ед,изъяв,жен S,жен,неод=вин,ед S,муж,од=(пр,ед|дат,ед)"
    assert codes(df, table) == [full, "", "EXCL"]
    assert codes(df, table, full=False)[0] == "S,жен,од PNT V,несов,пе S,жен,неод S,муж,од"
    assert codes(texts(spark, "мама; мыла раму"), table, scheme=None) == [
        "S,жен,од=им,ед V,несов,пе=прош,ед,изъяв,жен S,жен,неод=вин,ед"
    ]
    assert codes(texts(spark, "карандаш."), table, scheme="verbose") == ["S,муж,неод=(вин,ед|им,ед) POINT"]


def test_analyser_output(spark):
    kind = "doc int, morph array<struct<text string, analysis array<struct<gr string>>>>"
    first = [(" CM ", [("CM",)]), (" двадцать-два ", [("NUM=(вин|им)",)]), (" DSH ", [("DSH",)])]
    second = [
        (" CM ", [("CONJ=",)]), (" двадцать-два ", [("NUM=им",)]), (" DSH ", []), (" номер ", [("S,муж,неод=им,ед",)]),
        (" CM ", [("CONJ=",)]), (" помереть ", [("V,нп=инф,сов",)]), (" CL ", []), (" не ", [("PART=",)]),
        (" сейчас ", [("ADV=",)]), (" EXCL ", []),
    ]
    df = spark.createDataFrame([(0, first), (1, second)], kind)
    full = {r["doc"]: r["codes"] for r in lexicon.codes_from_morphology(df, "doc").collect()}
    brief = {r["doc"]: r["codes"] for r in lexicon.codes_from_morphology(df, "doc", full=False).collect()}
    assert full[0] == "CM NUM=(вин|им) DSH"
    assert brief[1] == "CONJ NUM S,муж,неод CONJ V,нп PART ADV"
    tags = {r["doc"]: r["tags"] for r in lexicon.morphology_tags(df, "doc").collect()}
    assert tags[1] == ["CONJ", "NUM", "S", "CONJ", "V", "PART", "ADV"]


def test_lemmas_keep_order_and_repeats(spark, table, joins):
    df = texts(spark, "мыла мама мыла раму и мыла", "!!!")
    rows = lexicon.lemmatize(df, table, T.word_tokens("text"), "doc").orderBy("doc").collect()
    assert [r["lemmas"] for r in rows] == [["мыть", "мама", "мыть", "рама", "и", "мыть"], []]


def test_pos_stats(spark, table, joins):
    df = texts(spark, "мир привет", "")
    rows = [r.asDict() for r in pos.pos_stats(df, table, "doc").orderBy("doc").collect()]
    assert rows[0] == {
        "doc": 0, "noun2verb": 1.0, "adj2noun": 0, "adv2verb": 0, "pr2noun": 0, "conj2noun": 0, "pron2noun": 0, "verb2word": 0.5,
    }
    assert set(rows[1].values()) == {1, 0.0}


def test_salted_join_equals_broadcast_on_a_hot_key(spark, monkeypatch):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id") % 50)).alias("form"))
    words = rows.select("form").distinct().where("form != 'w7'").withColumn("tag", F.upper("form"))
    near = scale.lookup_join(rows, words, ["form"], "left", salt_on=["id"])
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 1)
    far = scale.lookup_join(rows, words, ["form"], "left", salt_on=["id"])
    assert far.count() == 5000
    assert far.exceptAll(near).isEmpty() and near.exceptAll(far).isEmpty()


def test_drop_listed_and_build_lexicon(spark):
    rows = spark.createDataFrame([(0, 0, "a"), (0, 1, "b"), (1, 0, "a")], "doc int, pos int, token string")
    stop = spark.createDataFrame([("a",)], "token string")
    assert [r["token"] for r in lexicon.drop_listed(rows, stop).collect()] == ["b"]
    tagged = spark.createDataFrame(
        [("x", "x", "S", "S="), ("x", "x", "S", "S="), ("x", "y", "V", "V=")], "form string, lemma string, tag string, gr string"
    )
    assert [tuple(r) for r in lexicon.build_lexicon(tagged).collect()] == [("x", "x", "S", "S=")]


def test_recipes(spark, table):
    df = texts(spark, "Мама 12 мыла - раму, а я... http://t.co/abc не папе!", "   ")
    stop = ["не"]
    out = recipes.preprocess(df, table, "doc", stop=stop).orderBy("doc").collect()
    assert out[0]["text_preproc1"] == "мама мыть рама папа"
    assert out[0]["text_preproc3"] == "мама мыть рама а я папа"
    assert out[0]["text_preproc4"] == "мама мыть рама а я не папа"
    assert out[0]["text_preproc2"].split() == ["мама", "мыть", "-", "рама", ",", "...", "папа"]
    assert [out[1][f"text_preproc{i}"] for i in (1, 2, 3, 4)] == [""] * 4
    lists = recipes.preprocess(df, table, "doc", [4], as_text=False).orderBy("doc").collect()
    assert lists[0]["text_preproc4"] == ["мама", "мыть", "рама", "а", "я", "не", "папа"]
    rows = recipes.recipe_lemmas(df, table, "doc", 1, stop).orderBy("doc", "pos").collect()
    assert [r["lemma"] for r in rows] == ["мама", "мыть", "рама", "папа"]


def test_text_transformer(spark, table, tmp_path):
    path = str(tmp_path / "lexicon")
    table.write.parquet(path)
    df = texts(spark, "Мама, мыла не раму!")
    plain = recipes.TextTransformer(stopwords=["не"])
    assert plain.transform(df).first()["tokens"] == ["мама", "мыла", "раму"]
    marks = recipes.TextTransformer(removePunctuation=False, removeStopwords=False)
    assert marks.transform(df).first()["tokens"] == ["мама", ",", "мыла", "не", "раму", "!"]
    lemmas = recipes.TextTransformer(stopwords=["не"], lemmatize=True, lexiconPath=path, idCol="doc")
    lemmas.save(str(tmp_path / "stage"))
    again = recipes.TextTransformer.load(str(tmp_path / "stage"))
    assert again.transform(df).first()["tokens"] == ["мама", "мыть", "рама"]
