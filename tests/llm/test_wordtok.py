import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from aerostat.llm import wordtok as wt

TOK = wt.WordTokenizer(wt.default_path())
PIECES = st.sampled_from(["word", "Word's", "É", "é", "ß", "×", " ", "  ", "\n", "\x1c", "\x85", "\xa0", ".", ",", "..", "!?", "_", "1", "23", "<|endoftext|>", "<|", "don't", "İ", "Σ", "я", "中", "😀", "é", "'ll", "\0"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=12).map("".join), max_size=4))
def test_ids_are_the_library_s(texts):
    got = TOK.ids16([t.encode() for t in texts])
    assert got == [np.array(TOK.tok.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]


def test_null_is_empty_and_the_cache_may_start_anew(monkeypatch):
    monkeypatch.setattr(wt, "CACHE_WORDS", 3)
    small = wt.WordTokenizer(wt.default_path())
    texts = [b"a b c d e", None, b"f g h", b""]
    assert small.ids16(texts) == [small._encode((t or b"").decode()) for t in texts]
    assert small.ids16(texts) == [small._encode((t or b"").decode()) for t in texts]


def test_both_libraries_run_the_same_merges():
    assert TOK.fast is not None
    words = ["harbour", "thblering", "enenschheit", "éauxtre", "a", "zz"]
    assert TOK._ids(words).tolist() == TOK.tok.encode(" ".join(words), add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a" * 100_000, "ab " * 50_000])
def test_long_texts(text):
    assert TOK.ids16([text.encode()])[0] == TOK._encode(text)
