"""The registered queries over the small tables: against DuckDB where SQL can express them."""

from collections import Counter

import duckdb
import pytest

from aerostat.llm import registry
from tests.conftest import SF001
from tools.oracle_check import TABLES, rows_of

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SF001)
    sql = con.sql(registry.ORACLE[name])
    assert {c: TYPES[t] for c, t in df.dtypes} == dict(zip(sql.columns, map(str, sql.types)))
    assert Counter(rows_of(df.columns, [tuple(r) for r in df.collect()])) == Counter(rows_of(sql.columns, sql.fetchall()))


CONTRACT = {
    "op1_pack_documents": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op2_extract_text": "page_id bigint, url string, text string, n_chars bigint",
    "op3_similarity_join": "doc_id bigint, class_id bigint, n_links bigint",
    "op6_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op8_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op9_top_k": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op10_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op11_part_codes": "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string",
    "op12_shared_search": "item_id bigint, rank int, doc_id bigint, score bigint",
    "op13_byte_pairs": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_of_the_contract(spark, name):
    df = registry.QUERIES[name](spark, SF001)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == CONTRACT[name]


def test_every_document_once(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    ids = sorted(r.doc_id for r in docs.collect())
    for name in ("op3_similarity_join", "op7_sentencepiece", "op8_language_id"):
        assert sorted(r.doc_id for r in registry.QUERIES[name](spark, SF001).select("doc_id").collect()) == ids
    assert registry.QUERIES["op7_sentencepiece"](spark, SF001).where("NOT restored").count() == 0
