import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerostat.llm import langid as li
from tests.conftest import SF001

DOCS = [(1, "the boats and the town", "en"), (2, "the ice and the year", "en"), (3, "die Stadt und das Eis", "de"), (5, "der Hafen und die Boote", "de"), (6, "the and", None), (None, "xx yy", "de")]


@pytest.fixture(scope="module")
def model(spark):
    return li.fit(spark.createDataFrame(DOCS, "doc_id long, text string, lang string"), "text", "lang", "doc_id")


def test_predictions_and_cases(spark, model):
    assert model.langs == ["de", "en"]
    texts = ["the town", "die Boote", "THE", "thees", None, "", "12 !?", "ыъ", "the", "the"]
    df = spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], "n long, text string, score string")
    got = [(r.lang_pred, r.score) for r in li.identify(df, model, "text", F.col("n")).orderBy("n").collect()]
    assert [g[0] for g in got] == ["en", "de", "en", "en", "und", "und", "und", "de", "en", "en"]
    assert all(0 <= s <= 1 for _, s in got) and got[4][1] == 0 and got[7][1] == 0.5


def test_unseen_words_back_off_to_shorter_grams(model):
    assert "boats" in model.tables[0] and "boat" not in model.tables[0]
    got = model.scores(["boatsman", "qqqqund", "ыъ", "boats"])
    assert got[0].argmax() == 1 and got[1].argmax() == 0  # by their 5- and 4-grams
    assert not got[2].any() and (got[3] == model.logs[model.tables[0]["boats"]]).all()
    assert model.scores([]).shape == (0, 2)


def test_held_out_is_crc32_modulo_three(spark):
    rows = spark.createDataFrame([(i,) for i in [None, *range(50)]], "doc_id long").withColumn("h", li.held_out("doc_id")).collect()
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = li.op8_language_id(spark, SF001).join(docs, "doc_id").where("held_out AND lang IS NOT NULL")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 30 and right / n >= 0.95


def test_sample_bound_and_labels_are_no_input(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = li.fit_documents(docs)
    changed = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("s"))
    a = li.identify(docs, model, "text", F.col("doc_id")).collect()
    assert sorted(map(str, a)) == sorted(map(str, li.identify(changed, model, "text", F.col("doc_id")).collect()))
    small = li.fit(docs, "text", "lang", "doc_id", sample_rows=5, table_rows=40)
    assert all(len(t) <= 40 for t in small.tables.values())


def test_nothing_to_learn_and_empty(spark, empty, messy):
    none = li.fit(empty, "text", "lang", "doc_id")
    assert none.langs == [] and {r.lang_pred for r in li.identify(messy, none, "text").collect()} == {"und"}
    model = li.fit(messy, "text", "lang", "doc_id")
    assert li.identify(empty, model, "text").count() == 0 and li.keep_identified(empty, model).count() == 0
    kept = li.keep_identified(messy, model)
    assert kept.schema == messy.schema
    rows = [r.text for r in kept.collect()]
    assert None not in rows and "" not in rows and "12 34 !!" not in rows and len(rows) >= 15


@pytest.mark.parametrize("langs", [[None, None], ["en", "en"]])
def test_without_two_languages_only_texts_without_letters_go(spark, langs):
    rows = [(1, "the boats", langs[0], 1), (2, "ыъ", langs[1], 2), (3, "12 !", "en" if langs[0] else None, 3), (4, None, None, 4), (5, "", None, 5), (1, "the boats", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    kept = li.keep_identified(docs, li.fit_documents(docs))
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == [1, 1, 2]


def test_a_column_of_too_many_labels_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(li, "MAX_LANGS", 1)
    with pytest.raises(ValueError, match="labels"):
        li.fit(spark.createDataFrame(DOCS, "doc_id long, text string, lang string"), "text", "lang", "doc_id")


def brute_languages(rows):
    """(doc_id, text, lang) -> doc_id: (language, score), from plain counts in double precision."""
    learn = [(t, lang) for i, t, lang in rows if t is not None and lang is not None and zlib.crc32(str(i).encode()) % 3 != 1]
    langs = sorted({lang for _, lang in learn})

    def split(text):
        return "".join(c if c.isalpha() else " " for c in text.lower()).split()

    def pieces(word, n):
        if n == 0:
            return [word]
        marked = word if n == 1 else "^" + word + "$"
        return [marked[a:a + n] for a in range(len(marked)) if a + n <= len(marked)]
    seen = {}
    for text, lang in learn:
        for word in split(text):
            for n in range(6):
                for g in pieces(word, n):
                    key = n, g
                    seen.setdefault(key, dict.fromkeys(langs, 0))[lang] += 1
    known, different, total = set(), {n: sum(k[0] == n for k in seen) for n in range(6)}, {}
    for n in range(6):
        for lang in langs:
            own = sorted((-c[lang], g) for (m, g), c in seen.items() if m == n and c[lang])
            known |= {(n, g) for _, g in own[:li.TABLE_ROWS]}
            total[n, lang] = -sum(c for c, _ in own) + different[n] / 2
    logs = {k: np.array([np.log((seen[k][lang] + 0.5) / total[k[0], lang]) for lang in langs]) for k in known}
    logs = {k: v - v.max() for k, v in logs.items()}
    out = {}
    for i, text, _ in rows:
        words = split(text or "")
        score = np.zeros(len(langs))
        for word in words:
            for n in (0, 5, 4, 3, 2, 1):
                found = [logs[n, g] for g in pieces(word, n) if (n, g) in logs]
                if found:
                    score = score + sum(found) / len(found)
                    break
        p = np.exp(score - score.max())
        out[i] = (langs[int(p.argmax())], 1 / p.sum()) if words else ("und", 0.0)
    return out


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang").collect()
    want = brute_languages([tuple(r) for r in docs])
    got = {r.doc_id: (r.lang_pred, r.score) for r in li.op8_language_id(spark, SF001).collect()}
    assert set(got) == set(want)
    for i, (lang, score) in want.items():
        assert got[i][0] == lang and got[i][1] == pytest.approx(score, abs=1e-4), i


def test_counts_and_totals_are_whole(spark):
    """A word below one language's quota but in another's keeps its count there, and totals hold all that was counted."""
    docs = spark.createDataFrame([(1, "a a a b b", "x"), (2, "c c c b b a", "y")], "doc_id long, text string, lang string")
    model = li.fit(docs, "text", "lang", "doc_id", lang_rows=1)
    assert set(model.tables[0]) == {"a", "c"}
    x, y = np.log([3.5 / 6.5, 1.5 / 7.5])  # 5 words in x, 6 in y, 0.5 for each of three different ones
    assert model.logs[model.tables[0]["a"]] == pytest.approx([0, y - x], abs=1e-6)


def test_vocabulary_does_not_shrink_with_more_languages(spark):
    rows = [(10 * i + j, " ".join(f"{lang}{w}" for w in ("eins", "zwei", "drei")), lang) for i, lang in enumerate("abcdefgh") for j in range(2)]
    for n in (2, 16):
        model = li.fit(spark.createDataFrame(rows[:n], "doc_id long, text string, lang string"), "text", "lang", "doc_id", lang_rows=3)
        assert sum(w.startswith("a") for w in model.tables[0]) == 3
