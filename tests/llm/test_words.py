import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from penprint.llm import words

TEXTS = ["", " ", "a", "A b\tC\x0bd\n\ne f", "é É ß", "x\x1cy z", "one two three four five six", "word " * 3000, " lead trail "]


def plain(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))


def test_words_are_found_and_equal_words_get_equal_hashes():
    hashes, bounds = words.word_hashes(pa.array([*TEXTS, None]))
    seen = {}
    for k, text in enumerate([*TEXTS, ""]):
        own = hashes[bounds[k] : bounds[k + 1]].tolist()
        assert len(own) == len(plain(text))
        for w, h in zip(plain(text), own):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abAB \n\té\x1cß", max_size=30), max_size=6))
def test_sliced_and_long_columns_give_the_same_hashes(texts):
    whole, bounds = words.word_hashes(pa.array(["first", *texts], pa.string()).slice(1))
    again, _ = words.word_hashes(pa.array(texts, pa.large_string()))
    assert whole.tolist() == again.tolist() and len(bounds) == len(texts) + 1


def test_blocks_do_not_change_hashes(monkeypatch):
    text = pa.array(["alpha beta " * 500, "x" * 5000 + " y"])
    expected = words.word_hashes(text)[0]
    monkeypatch.setattr(words, "BLOCK", 64)
    assert (words.word_hashes(text)[0] == expected).all()


def test_shingles_match_python_sets():
    sets, bounds = words.shingles(pa.array(TEXTS))
    names = {}
    for k, text in enumerate(TEXTS):
        w = plain(text)
        want = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        own = sets[bounds[k] : bounds[k + 1]]
        assert len(own) == len(want) and (np.diff(own.astype(object)) > 0).all()
        names.setdefault(frozenset(want), set()).add(own.tobytes())
    assert all(len(v) == 1 for v in names.values())
    assert Counter(len(v) for v in names.values())[1] == len(names)
