import pytest

from penprint.functions import text as T

LOWER = [
    ("TEST", "test"), ("TeSt", "test"), ("123 ABC", "123 abc"), ("", ""),
    ("СмЕшАнНыЙ РеГиСтР и кириллица", "смешанный регистр и кириллица"),
]
NUMBERS = [
    ("123test", "test"), ("te123st", "test"), ("1234567890", ""),
    ("Текст с цифрами 123 и без", "Текст с цифрами  и без"), ("123Текст456без7890цифр", "Текстбезцифр"),
]
LINKS = [
    ("Проверьте этот сайт http://t.co/example", "Проверьте этот сайт"),
    ("Посетите https://t.co/uniqueURL для получения информации", "Посетите для получения информации"),
    ("Этот текст содержит несколько ссылок http://t.co/first и https://t.co/second", "Этот текст содержит несколько ссылок и"),
    ("Текст с невалидной ссылкой https://example.com", "Текст с невалидной ссылкой https://example.com"),
    ("", ""),
]
SHORT = [
    ("Я и ты пошли в зоопарк", "пошли зоопарк"), ("An example with English", "example with English"),
    ("a bc def ghi j klmn op", "def ghi klmn"), ("12 345 6789 0", "345 6789"), ("", ""), ("а я", ""),
    ("This is a test", "This test"),
]
MARKS = [
    ("Привет, мир!", "Привет мир"), ("Какой-то текст (со скобками).", "Какой-то текст со скобками"),
    ("Текст[с]разными<знаками>пунктуации.", "Текст с разными знаками пунктуации"), (" ", ""),
]
CLEAN = [
    ("Привет! Как дела?", "Привет! Как дела?"), ("Тест: 1234567890", "Тест: "),
    ("English text with numbers 123", "    "), ("Символы: @#$%^&*()", "Символы: ()"),
    ("Пример с дефисами - и тире —", "Пример с дефисами - и тире "),
    ("Кавычки: «Кириллица», 'Latin'", "Кавычки: Кириллица, ''"), ("Яблоки na snegu !", "Яблоки   !"),
    ("Ёклмн, xyz:~!", "Ёклмн, :!"),
    ("как-то - 'рано' 'Marta'? пела: лЕСОМ, * &нифига(она) не ела", "как-то - 'рано' ''? пела: лЕСОМ,  нифига(она) не ела"),
]
CORE = [
    ("Это предложение.", "Это предложение PNT "), ("А это - пример с тире.", "А это DSH пример с тире PNT "),
    ("Как насчет вопроса?", "Как насчет вопроса QST "), ("Двоеточие: так", "Двоеточие CL  так"),
    ("Точка с запятой;", "Точка с запятой SMC "), ("Эллипсис...", "Эллипсис MP "),
    ("Двойной эллипсис..", "Двойной эллипсис MP "), ("Запятая, да", "Запятая CM  да"),
    (", двадцать-два, - номер, помереть: не сейчас!", " CM  двадцать-два CM  DSH номер CM  помереть CL  не сейчас EXCL "),
]
VERBOSE = [
    ("Вот видишь: лето, ОСЕНЬ! '!?'", "Вот видишь COLON  лето COMMA  ОСЕНЬ EXCL  ' EXCL  QST '"),
    ("Ёклмн, xyz:~!", "Ёклмн COMMA  xyz COLON ~ EXCL "),
]
CASES = [
    (T.to_lower, LOWER), (T.remove_numbers, NUMBERS), (T.remove_http, LINKS), (T.remove_short_words, SHORT),
    (T.remove_punctuation, MARKS), (T.clean_sentence, CLEAN), (T.encode_punct, CORE),
    (lambda c: T.encode_punct(c, "verbose"), VERBOSE),
]


@pytest.mark.parametrize("fn,pairs", CASES)
def test_scalars(spark, fn, pairs):
    rows = spark.createDataFrame(list(enumerate(a for a, _ in pairs)), "i int, text string")
    got = [r["x"] for r in rows.select("i", fn("text").alias("x")).orderBy("i").collect()]
    assert got == [b for _, b in pairs]


def test_tokens(one):
    assert one("Привет, мир! Это тест.", T.word_tokens) == ["привет", "мир", "это", "тест"]
    assert one("Да... нет? «Ой» — так: вот; эх!", T.punct_tokens) == ["...", "?", "«", "—", ":", ";", "!"]
    stop = ["и", "в", "на", "с"]
    assert one("Я иду в магазин", lambda c: T.remove_stopwords(T.treebank_tokens(c), stop)) == ["Я", "иду", "магазин"]
    assert one("и в с", lambda c: T.remove_stopwords(T.treebank_tokens(c), stop)) == []
    assert one("Кто-то... ушёл, да?", T.treebank_tokens) == ["Кто-то", "...", "ушёл", ",", "да", "?"]
    assert one("Раз. Два! Три? Четыре", T.sentences) == ["Раз.", "Два!", "Три?", "Четыре"]


def test_spacing_and_prose(one):
    assert one("дышать.В  поле\nбыло:так", T.repair_spacing) == "дышать. В поле было: так"
    assert one("что-то - там, x!", T.strip_for_morph) == "что-то там "
    assert one("Вот 12 https://a.b/c?d сайт,\nда!", T.plain_prose) == "вот сайт да"


def test_token_filter(one):
    rules = dict(stop=["это"], min_length=3)
    got = one("это дом ", lambda c: T.filter_tokens(T.chunk_tokens(c), **rules))
    assert got == ["дом"]
    assert one("a - b", lambda c: T.filter_tokens(T.chunk_tokens(c))) == ["a", "b"]


def test_tags_and_labels(one):
    assert one("S,муж,неод=им,ед", T.short_tag) == "S"
    assert one("S-PRO,ед=им", T.short_tag) == "S"
    assert one("V,нп=инф,сов", T.brief_grammar) == "V,нп"
    assert one("author_id_07", T.target_to_int) == 7
    assert one("author_id_12", T.target_to_int) == 12
    assert one("-1", T.label_name) == "не могу определить автора"
    assert one("9", T.label_name) == "Ф. Достоевский"


def test_file_name(spark):
    row = spark.createDataFrame([("Федор Достоевский", "Бедные  люди")], "a string, t string")
    assert row.select(T.make_file_name("a", "t").alias("x")).first()["x"] == "fedor_dostoevskij_bednye_ljudi"


def test_russian_stopwords(spark):
    listed = T.russian_stopwords(spark)
    kept = T.russian_stopwords(spark, keep_negations=True)
    assert {"и", "в", "не", "ни"} <= set(listed)
    assert set(listed) - set(kept) == {"не", "ни"}
