"""Language identification: whole words first, then ever shorter character n-grams.

A model holds, per language, the log frequency of its frequent words and of its character n-grams
(lengths 5 down to 1, with marks for a word's ends). A known word counts with its word frequencies; an
unseen word counts with the mean over its known n-grams of the greatest length that has any. A
document's score per language is the sum over all its words, and ``score`` is the normalised likelihood
of the best language (0 to 1).

Learning takes a bounded sample of labelled rows: at most about ``SAMPLE_ROWS`` per language in
expectation, chosen by a hash of the id, whole texts; counts are summed in Spark. The vocabulary of each kind
is the union of the ``TABLE_ROWS`` most frequent entries of every language, and each entry has its true count in
every language; totals are over all that was counted. So the model grows with the number of languages, not with the data,
and is no coarser for more of them. Prediction reads every row and whole texts.

Cases: a null text or one without a letter is ``und`` with score 0; a text whose letters are all unknown
gets the language with the most labelled rows (ties: the first by name), with the score of a draw;
with nothing to learn from every row is ``und`` (and :func:`keep_identified` takes away only those without letters);
more than ``MAX_LANGS`` different labels are an error; repeated rows are predicted alike; rows with a null
language or null id are not learned from; columns beside those named are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from aerostat.llm.common import resident, sliced, table, written

#: labelled rows to learn from, per language (expected number)
SAMPLE_ROWS = 2_000
#: entries of each kind (words; n-grams of one length) that a language brings into the model
TABLE_ROWS = 24_000
NGRAMS = (5, 4, 3, 2, 1)
UNKNOWN = "und"
#: different labels; more are an error, since a column of so many is no language column
MAX_LANGS = 1_000
#: words whose scores a Python worker keeps
CACHE_WORDS = 150_000

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters."""
    return _WORD.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    marked = f"^{word}$" if n > 1 else word
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


class Model:
    """``tables[0]`` maps words, ``tables[n]`` n-grams to a row of ``logs``, which has a column per language."""

    def __init__(self, langs: list[str], rows: list[int], counts: pd.DataFrame, totals: pd.DataFrame):
        self.langs = langs
        self.prior = int(np.lexsort((langs, [-r for r in rows]))[0]) if langs else -1
        self.tables: dict[int, dict[str, int]] = {}
        self.key = uuid.uuid4().hex
        index = {lang: i for i, lang in enumerate(langs)}
        parts = [np.zeros((0, len(langs)), np.float32)]
        for kind, part in counts.groupby("kind"):
            grams, at = np.unique(part.gram.to_numpy(object).astype(str), return_inverse=True)
            seen = np.zeros((len(grams), len(langs)))
            np.add.at(seen, (at, part.lang.map(index).to_numpy()), part.n.to_numpy())
            of_kind = totals[totals.kind == kind]
            total = 0.5 * np.full((1, len(langs)), of_kind.grams.iloc[0])
            total[0, of_kind.lang.map(index).to_numpy()] += of_kind.n.to_numpy()
            logs = (np.log(seen + 0.5) - np.log(total)).astype(np.float32)
            first = sum(map(len, parts))
            parts.append(logs - logs.max(axis=1, keepdims=True))  # only differences between languages matter
            self.tables[int(kind)] = {g: first + i for i, g in enumerate(grams.tolist())}
        self.logs = np.concatenate(parts)

    def _entries(self, word: str) -> list[int]:
        """The word's own row, or those of its known n-grams of the greatest length that has any."""
        known = self.tables.get(0, {}).get(word)
        if known is not None:
            return [known]
        for n in NGRAMS:
            get = self.tables.get(n, {}).get
            found = [i for g in grams_of(word, n) if (i := get(g)) is not None]
            if found:
                return found
        return []

    def scores(self, words: list[str]) -> np.ndarray:
        """A row per word; zeros if nothing of it is known."""
        entries = [self._entries(w) for w in words]
        sizes = np.fromiter(map(len, entries), np.int64, len(entries))
        out = np.zeros((len(words), len(self.langs)), np.float32)
        some = sizes > 0
        if some.any():
            flat = np.fromiter((i for e in entries for i in e), np.int64, int(sizes.sum()))
            starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
            out[some] = np.add.reduceat(self.logs[flat], starts, axis=0) / sizes[some][:, None]
        return out


class Scorer:
    """Scores texts with a model, keeping the scores of words it has met (bounded)."""

    def __init__(self, model: Model):
        self.model, self.index = model, {}
        self.rows = np.zeros((1024, len(model.langs)), np.float32)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        words = [words_of(t) if t else [] for t in texts]
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.model.langs:
            return langs, scores
        new = set().union(*words).difference(self.index)
        if len(self.index) + len(new) > CACHE_WORDS:
            self.index.clear()
            new = set().union(*words)
        while len(self.index) + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        new, first = list(new), len(self.index)
        self.rows[first:first + len(new)] = self.model.scores(new)
        self.index.update(zip(new, range(first, first + len(new))))
        get = self.index.__getitem__
        for i, ws in enumerate(words):
            if not ws:
                continue
            total = self.rows[np.fromiter(map(get, ws), np.int64, len(ws))].sum(axis=0, dtype=np.float64)
            total -= total.max()
            best = self.model.prior if not total.any() else int(total.argmax())
            langs[i], scores[i] = self.model.langs[best], float(1 / np.exp(total).sum())
        return langs, scores


def fit(labelled: DataFrame, text_col: str, lang_col: str, id_col: str, sample_rows: int = SAMPLE_ROWS,
        table_rows: int | None = None, lang_rows: int = TABLE_ROWS) -> Model:
    """Learn from rows whose text, language and id are not null.

    ``lang_rows`` bounds the entries of a kind that a language brings in; ``table_rows``, where given, those of all languages together.
    """
    rows = (labelled.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"),
                            F.col(id_col).cast("string").alias("id")).where("text IS NOT NULL AND lang IS NOT NULL AND id IS NOT NULL"))
    have = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGS + 1).collect()}
    if len(have) > MAX_LANGS:
        raise ValueError(f"{lang_col} holds more than {MAX_LANGS} different labels")
    langs = sorted(have)
    if not langs:
        return Model([], [], pd.DataFrame({"kind": [], "lang": [], "gram": [], "n": []}), pd.DataFrame({"kind": [], "lang": [], "n": [], "grams": []}))
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, sample_rows / have[lang]))])
    place = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(place < share[F.col("lang")]).select("text", "lang")

    def count(batches):
        names = ["kind", "lang", "gram", "n"]
        for b in sliced(batches, "text", 1 << 20):
            by_lang: dict[str, Counter] = {}
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                by_lang.setdefault(lang, Counter()).update(words_of(text))
            for lang, found in by_lang.items():
                for n in (0, *NGRAMS):
                    c = found if n == 0 else Counter()
                    if n:
                        for word, k in found.items():
                            for g in grams_of(word, n):
                                c[g] += k
                    yield pa.RecordBatch.from_arrays([pa.array([n] * len(c), pa.int32()), pa.array([lang] * len(c), pa.string()),
                                                      pa.array(c.keys(), pa.string()), pa.array(c.values(), pa.int64())], names)

    counts = sample.mapInArrow(count, "kind int, lang string, gram string, n long").groupBy("kind", "lang", "gram").agg(F.sum("n").alias("n"))
    counts = written(counts, "languages")
    quota = lang_rows if table_rows is None else min(lang_rows, max(1, table_rows // len(langs)))
    best = Window.partitionBy("kind", "lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("r", F.row_number().over(best)).where(F.col("r") <= quota).select("kind", "gram").distinct()
    different = counts.groupBy("kind").agg(F.count_distinct("gram").alias("grams"))
    totals = counts.groupBy("kind", "lang").agg(F.sum("n").alias("n")).join(different, "kind")
    return Model(langs, [have[x] for x in langs], counts.join(top, ["kind", "gram"], "left_semi").toArrow().to_pandas(), totals.toPandas())  # Arrow: no row objects on the driver


def identify(docs: DataFrame, model: Model, text_col: str, *keep: Column) -> DataFrame:
    """The columns ``keep`` of every row with ``lang_pred`` and ``score``."""
    kept = docs.select(*keep).schema
    names = kept.names
    named = docs.select(*[c.alias(f"c{i}") for i, c in enumerate(keep)], F.col(text_col).cast("string").alias("text"))
    live = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        model = live.value
        scorer = resident(("languages", model.key), lambda: Scorer(model))
        for b in sliced(batches, "text"):
            langs, scores = scorer.predict(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             [*names, "lang_pred", "score"])

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return named.mapInArrow(predict, T.StructType([*kept.fields, *added]))


def held_out(id_col: str) -> Column:
    """True where crc32 of the id as text, modulo 3, is 1 (a null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_documents(docs: DataFrame) -> Model:
    return fit(docs.where(~held_out("doc_id")), "text", "lang", "doc_id")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit_documents(docs), "text", F.col("doc_id"), held_out("doc_id").alias("held_out"))


def _with_letters(docs: DataFrame, text: str) -> DataFrame:
    def search(batches):
        for b in sliced(batches, text):
            yield b.filter(pa.array([bool(t and words_of(t)) for t in b.column(text).to_pylist()], pa.bool_()))
    return docs.mapInArrow(search, docs.schema)


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (columns as they were) without the rows that have no language: no letters, or nothing that the
    model knows (the score of a draw of all languages).

    A draw needs two languages. A model of one or none tells no texts apart, so only texts without letters go.
    """
    names = docs.columns
    named = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index('text')}"
    if len(model.langs) < 2:
        return _with_letters(named, text).toDF(*names)
    out = identify(named, model, text, *[F.col(c) for c in named.columns])
    draw = (1 + 1e-9) / len(model.langs)
    return out.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") > draw)).select(*named.columns).toDF(*names)
