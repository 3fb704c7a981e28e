"""Patterns, mark lists, codes and names that results depend on."""

# Word patterns.
CYRILLIC_WORD = "[А-яЁё]+"
ANY_WORD = r"\p{L}+"

# Characters that count as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The punctuation marks counted per text, with column names.
TEXT_MARKS = {
    "...": "ellipsis",
    ".": "period",
    ",": "comma",
    "—": "dash",
    "?": "question",
    "«": "laquo",
    ":": "colon",
    "!": "exclam",
    ";": "semicolon",
}
MARK_PATTERN = r"(?:\.{3})|[.,—?«:!;]"

# The punctuation marks counted per sentence, with column names.
SENTENCE_MARKS = {
    '"': "dquote",
    "!": "exclam",
    "'": "squote",
    "(": "lparen",
    ")": "rparen",
    "*": "asterisk",
    ",": "comma",
    "-": "hyphen",
    ".": "period",
    ":": "colon",
    ";": "semicolon",
    "?": "question",
}

# Marks blanked by punctuation removal.
BLANKED_MARKS = "!()[]{};«№»:'\",`<>./?@=#$%^&*~"

# ASCII punctuation, in code point order.
ASCII_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Marks kept by sentence cleaning, besides the alphabet.
KEPT_MARKS = " \\-\"!'(),.:;?"

# Code words for marks, in the order they are applied.
MARK_CODES = {
    "core": [
        ("...", "MP"),
        ("..", "MP"),
        (".", "PNT"),
        (",", "CM"),
        ("?", "QST"),
        ("!", "EXCL"),
        (":", "CL"),
        (";", "SMC"),
    ],
    "verbose": [
        (".", "POINT"),
        (",", "COMMA"),
        ("?", "QST"),
        ("!", "EXCL"),
        (":", "COLON"),
        (";", "SEMICOL"),
    ],
}
FREE_DASH_CODE = {"core": "DSH", "verbose": "DASH"}

# Part-of-speech tags counted for ratios.
RATIO_TAGS = ["V", "S", "A", "ADV", "PR", "CONJ", "S-PRO", "A-PRO"]

# Part-of-speech tags of the sentence profile.
PROFILE_TAGS = [
    "A", "ADV", "ADVPRO", "ANUM", "APRO", "COM", "CONJ",
    "INTJ", "NUM", "PART", "PR", "S", "SPRO", "V",
]

# Sentence lengths shown in profiles.
PROFILE_LENGTHS = [3, 7, 12, 18, 25]

# Tags kept for topics, and words left out of them.
TOPIC_TAGS = ["NOUN", "ADJ", "VERB"]
TOPIC_STOPWORDS = [
    "антошка", "аркадий", "бухарбай", "быть", "еремка", "иван", "ивановна",
    "иваныч", "макар", "митя", "марья", "может", "мочь", "наташа", "нет",
    "петрович", "петрушка", "прошка", "раз", "сам", "сами", "самое", "самый",
    "сергеевна", "тарас", "фрося", "хотеть", "хотел",
]

# Negations kept when Russian stop words are dropped.
KEPT_STOPWORDS = ["не", "ни"]

# Author names by label; -1 stands for an undecided text.
UNDECIDED = -1
AUTHOR_NAMES = {
    -1: "не могу определить автора",
    0: "А. Пушкин",
    1: "Д. Мамин-Сибиряк",
    2: "И. Тургенев",
    3: "А. Чехов",
    4: "Н. Гоголь",
    5: "И. Бунин",
    6: "А. Куприн",
    7: "А. Платонов",
    8: "В. Гаршин",
    9: "Ф. Достоевский",
}

# Author prefix of a raw book.
PREFIX_LENGTH = 12
PREFIX_STEM = "author_id_"

# Letters for character n-grams.
RUSSIAN_LETTERS = "абвгдеёжзийклмнопрстуфхцчшщъыьэюя"

# Token pattern of grammar codes.
GRAMMAR_TOKEN = r"(?U)\b[a-zA-Zа-яА-ЯёЁ0-9,=|\-]+\b"

# Vowels for syllable counts (Russian, and Latin for other languages).
RUSSIAN_VOWELS = "аеёиоуыэюя"
LATIN_VOWELS = "aeiouyàâäáéèêëíîïóôöúùûüœæ"

# Cyrillic to Latin, one letter to one, and one letter to several.
TRANSLIT_SINGLE = ("абвгдезийклмнопрстуфхыэё", "abvgdezijklmnoprstufhyee")
TRANSLIT_MULTI = {
    "ж": "zh",
    "ц": "ts",
    "ч": "ch",
    "ш": "sh",
    "щ": "sch",
    "ю": "ju",
    "я": "ja",
    "ъ": "'",
    "ь": "'",
}
