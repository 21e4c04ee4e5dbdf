import zlib

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as ent
import corpus_pipeline as cp
from aerostat.llm import langid as li
from aerostat.llm.wordtok import WordTokenizer, default_path
from tests.conftest import SF001
from tests.llm.conftest import MESSY, frame
from tests.llm.test_exact_dedup import strip
from tests.llm.test_similarity_join import brute as near_brute


def expected(rows, model):
    """Brute force: rows (id, text) that every filtering stage keeps."""
    scorer = li.Scorer(model)
    langs, scores = scorer.predict([t for _, t in rows])
    rows = [r for r, lang, s in zip(rows, langs, scores) if lang != "und" and s > (1 + 1e-9) / len(model.langs)]
    best = {}
    for i, t in rows:
        key = strip(t)
        order = (-len(t), i is None, i or 0)
        if key not in best or order < best[key][0]:
            best[key] = order, (i, t)
    rows = [r for _, r in best.values()]
    classes = {}
    for i, c, _ in near_brute(rows):
        classes.setdefault(c if c != "None" else i, []).append(i)
    keep = {min(v, key=lambda x: (x == "None", int(x) if x != "None" else 0)) for v in classes.values()}
    return [r for r in rows if str(r[0]) in keep]


def run_stages(spark, docs, files):
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, None)
        assert out.schema == docs.schema
        docs = files(out)
    return docs


def test_stages_match_brute_force(spark, files):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = expected(rows, li.fit_documents(docs))
    got = run_stages(spark, docs, files)
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i, _ in want)
    tok = WordTokenizer(default_path()).tok
    out = cp.run(spark, SF001).collect()
    ids = {i: np.array([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4") for i, t in want}
    assert sum(r.length for r in out) == sum(map(len, ids.values()))
    assert all(zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32 for r in out)


def test_messy_and_empty_documents(spark, files, messy, empty):
    kept = run_stages(spark, messy, files).collect()
    assert len(kept) < len(MESSY) and {r.doc_id for r in kept} >= {11, 14}
    docs = run_stages(spark, empty, files)
    assert docs.count() == 0 and cp.STAGES[-1][1](spark, docs, None).count() == 0


def test_clean_documents_stay(spark, files):
    docs = files(frame(spark, [(i, f"the boats of the town {i} came back in spring number {i} and {i * 7} people saw them") for i in range(40)]))
    assert run_stages(spark, docs, files).count() == 40


def test_registered(spark):
    names = ent.queries()
    assert [n for n in names if n.startswith("op")] and "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{i}" for i in range(1, 14)}
    assert len(cp.STAGES) == 4 and set(ent.oracle_sql()) <= set(names)
    assert ent.queries()["op10_exact_dedup"](spark, SF001).where(F.col("kept")).count() > 0
