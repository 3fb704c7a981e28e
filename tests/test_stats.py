import pytest

from penprint.functions import fixed
from penprint.operators import pos, profiles, stats
from penprint.operators.extractor import TextStatsExtractor, stat_columns


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "doc int, text string")


def test_sent_stats(spark):
    row = stats.sent_stats(texts(spark, "Привет... Как дела? Хорошо! Отлично.")).first().asDict()
    assert {k: row[k] for k in ("ellipsis", "period", "question", "exclam", "comma", "dash")} == {
        "ellipsis": 1, "period": 1, "question": 1, "exclam": 1, "comma": 0, "dash": 0,
    }
    assert row["avg_snt_len"] == 9
    many = stats.sent_stats(texts(spark, "а.... б..", "нет точек")).orderBy("doc").collect()
    assert (many[0]["ellipsis"], many[0]["period"]) == (1, 3)
    assert many[1]["avg_snt_len"] == 9


def test_token_stats(spark):
    rows = stats.token_stats(texts(spark, "привет мир мир привет", "123")).orderBy("doc").collect()
    assert (rows[0]["avg_tkn_len"], rows[0]["ttr"]) == (4.5, 0.5)
    assert (rows[1]["avg_tkn_len"], rows[1]["ttr"]) == (0.0, 0.0)


def test_text_stats_columns(spark):
    words = spark.createDataFrame([("тест", "тест", "S", "S=")], "form string, lemma string, tag string, gr string")
    df = texts(spark, "Привет... Как дела? Хорошо! Отлично.", "Тест. Тест, тест.")
    out = pos.text_stats(df, "doc", lexicon=words)
    assert set(out.columns) == {"doc", "text", *stat_columns()}
    rows = {r["doc"]: r for r in out.collect()}
    assert rows[1]["punct2word"] == 1.0
    assert rows[0]["punct2word"] == pytest.approx(4 / 5)
    off = pos.text_stats(df, "doc", sent=False, pos=False)
    assert {r["punct2word"] for r in off.collect()} == {0.0}
    with pytest.raises(ValueError):
        pos.text_stats(df, "doc", sent=False, tkn=False, pos=False)


def test_extractor_stage(spark, tmp_path):
    words = spark.createDataFrame([("тест", "тест", "S", "S=")], "form string, lemma string, tag string, gr string")
    words.write.parquet(str(tmp_path / "lex"))
    stage = TextStatsExtractor(lexiconPath=str(tmp_path / "lex"), idCol="doc")
    out = stage.transform(texts(spark, "Тест. Тест, тест."))
    assert out.first()["stats"].size == 20 and out.columns == ["doc", "text", "stats"]
    with pytest.raises(ValueError):
        TextStatsExtractor(sentStats=False, tknStats=False, posStats=False)


def test_basic_stats(spark):
    rows = stats.basic_stats(texts(spark, "Мама мыла раму. Папа ел!\nПерепутавший", " ... ")).orderBy("doc").collect()
    first = rows[0].asDict()
    assert first["n_sents"] == 3 and first["n_words"] == 6 and first["n_unique_words"] == 6
    assert first["n_long_words"] == 1 and first["n_complex_words"] == 1 and first["n_simple_words"] == 5
    assert first["n_monosyllable_words"] == 1 and first["n_polysyllable_words"] == 5
    assert first["n_syllables"] == 2 * 4 + 1 + 5 and first["n_punctuations"] == 2 and first["n_spaces"] == 4
    assert all(rows[1][c] is None for c in stats.BASIC_STATS)


def test_sentence_stats(spark):
    rows = stats.sentence_stats(texts(spark, 'Он сказал: "да".И ушёл (домой)! Конец')).orderBy("pos").collect()
    assert [r["sentence"] for r in rows] == ['Он сказал: "да".И ушёл (домой)!', "Конец"]
    assert rows[0]["dquote"] == 2 and rows[0]["lparen"] == 1 and rows[0]["period"] == 1 and rows[0]["n_words"] == 5
    assert set(fixed.SENTENCE_MARKS.values()) <= set(rows[0].asDict())


def test_sentence_length_places(spark):
    df = spark.createDataFrame([("a", "Раз. Раз. Раз два. Раз два три.")], "author string, text string")
    rows = profiles.sentence_length_dist(df, "author").orderBy("place").collect()
    assert [(r["place"], r["n_words"], r["freq"]) for r in rows] == [(1, 2, 0.25), (2, 3, 0.25)]


def test_profile_for_lengths(spark):
    df = spark.createDataFrame([("a", "Раз, два, три. Раз два три! Ой.")], "author string, text string")
    shown = profiles.at_lengths(profiles.punct_profile(df, "author")).collect()
    assert [(r["n_words"], r["comma"], r["exclam"], r["n_sents"]) for r in shown] == [(3, 1.0, 0.5, 2)]
