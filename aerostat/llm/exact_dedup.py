"""Exact deduplication by an exchange of Golomb-coded fingerprints.

Texts are equal when they are identical after deletion of ASCII white space (``[\\x20\\x09-\\x0D]``).

1. Every input partition fingerprints its texts (48 bits) and sends each owner of a hash range its
   sorted distinct fingerprints, as Golomb-Rice coded gaps; a fingerprint that repeats inside the
   partition is sent once, with a flag.
2. An owner merges what it gets, and answers each sender with a bitmap: which of its fingerprints
   occur more than once overall.
3. A second pass over the input sends on only the suspects' texts, pre-aggregated per task, and groups
   them by their bytes. No other text is shuffled, and a group of copies reaches the reducer as at most
   one row per slice of a task, whatever its size.
4. The decisions are joined to the rows' metadata (no texts) by SHA-256.

Cases: a null text counts as empty; a null id sorts after all others; of repeated rows (same id and
text) exactly one is kept; an empty table gives no rows; columns beside id and text are carried by
:func:`deduplicate` and otherwise ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from aerostat.llm.common import new_folder, release, sliced, table, utf8, written
from aerostat.llm import sidefiles
from aerostat.llm.sidefiles import proof, received, send_back

#: bits of a fingerprint; more suspects are false with fewer, never more results
BITS = 48
_BLANK = b" \t\n\x0b\x0c\r"


def golomb_encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Sorted distinct unsigned integers as (remainder bits, unary quotients, remainders) of their gaps."""
    gaps = np.diff(values, prepend=np.uint64(0))
    mean = max(1.0, float(values[-1]) / len(values))
    bits = max(0, int(np.log2(0.69 * mean))) if mean > 1.45 else 0
    q = (gaps >> np.uint64(bits)).astype(np.int64)
    unary = np.zeros(int(q.sum()) + len(q), np.uint8)
    unary[np.cumsum(q + 1) - 1] = 1
    rest = ((gaps[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return bits, np.packbits(unary).tobytes(), np.packbits(rest).tobytes()


def golomb_decode(n: int, bits: int, unary: bytes, rest: bytes) -> np.ndarray:
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    q = np.diff(ones, prepend=-1) - 1
    low = np.unpackbits(np.frombuffer(rest, np.uint8), count=n * bits).reshape(n, bits).astype(np.uint64)
    gaps = (q.astype(np.uint64) << np.uint64(bits)) + (low << np.arange(bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def _fingerprints(texts: list[bytes]) -> np.ndarray:
    raw = np.fromiter((xxhash.xxh3_64_intdigest(t) for t in texts), np.uint64, len(texts))
    return raw >> np.uint64(64 - BITS)


def _stripped(column: pa.Array) -> list[bytes]:
    return [t.translate(None, _BLANK) if t else b"" for t in utf8(column)]


def _lengths(column: pa.Array) -> list[int]:
    return pa.compute.utf8_length(column).fill_null(0).to_pylist()


def _input(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.spark_partition_id().alias("part"), sidefiles.mark(sidefiles.seq(), F.col(id_col)).alias("mark"))


_NOTE = "part int, owner int, n int, bits int, unary binary, rest binary, twice binary"


def _first_pass(source: DataFrame, owners: int) -> DataFrame:
    """Rows of kind ``row`` (metadata of each text) and ``note`` (coded fingerprints for one owner)."""
    kind = source.schema["id"].dataType.simpleString()
    schema = f"kind string, part int, seq long, id {kind}, n_chars long, sha string, owner int, n int, bits int, unary binary, rest binary, twice binary"
    width = (1 << BITS) // owners + 1

    def read(batches):
        release()
        part, seq, prints, arrow_kind = None, 0, [], None
        for b in sliced(batches, "text"):
            part, arrow_kind = b.column("part")[0].as_py(), b.schema.field("id").type
            texts = _stripped(b.column("text"))
            prints.append(_fingerprints(texts))
            n = len(texts)
            none = {k: pa.nulls(n, t) for k, t in (("owner", pa.int32()), ("n", pa.int32()), ("bits", pa.int32()),
                                                   ("unary", pa.binary()), ("rest", pa.binary()), ("twice", pa.binary()))}
            yield pa.RecordBatch.from_pydict({
                "kind": ["row"] * n, "part": pa.array([part] * n, pa.int32()), "seq": pa.array(range(seq, seq + n), pa.int64()),
                "id": b.column("id"), "n_chars": pa.array(_lengths(b.column("text")), pa.int64()),
                "sha": [hashlib.sha256(t).hexdigest() for t in texts]} | none)
            seq += n
        if part is None:
            return
        values, counts = np.unique(np.concatenate(prints), return_counts=True)
        owner = (values // np.uint64(width)).astype(np.int64)
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        out = {k: [] for k in ("owner", "n", "bits", "unary", "rest", "twice")}
        for a, z in zip(starts, [*starts[1:], len(values)]):
            coded = golomb_encode(values[a:z] - np.uint64(int(owner[a]) * width))
            for k, v in zip(out, (int(owner[a]), int(z - a), *coded, np.packbits(counts[a:z] > 1).tobytes())):
                out[k].append(v)
        n = len(starts)
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_pydict({
            "kind": ["note"] * n, "part": pa.array([part] * n, pa.int32()), "seq": pa.nulls(n, pa.int64()), "id": pa.nulls(n, arrow_kind),
            "n_chars": pa.nulls(n, pa.int64()), "sha": pa.nulls(n, pa.string())} | {k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds)})

    return source.mapInArrow(read, schema)


def _answer(notes: pd.DataFrame) -> pd.DataFrame:
    """An owner's bitmaps: 1 where a fingerprint occurs again, in the same or another partition."""
    sent = [golomb_decode(n, b, u, r) for n, b, u, r in zip(notes.n, notes.bits, notes.unary, notes.rest)]
    again = [np.unpackbits(np.frombuffer(t, np.uint8), count=n).astype(bool) for t, n in zip(notes.twice, notes.n)]
    every = np.concatenate(sent)
    order = np.argsort(every, kind="stable")
    same = every[order][1:] == every[order][:-1]
    marks = np.zeros(len(every), bool)
    marks[order[1:]] |= same
    marks[order[:-1]] |= same
    ends = np.cumsum(notes.n.to_numpy())
    return notes.assign(twice=[np.packbits(m | a).tobytes() for m, a in zip(np.split(marks, ends[:-1]), again)])


def _suspects(source: DataFrame, answers: str, owners: int) -> DataFrame:
    """Second pass: texts whose fingerprint occurs more than once, one row per distinct text and slice."""
    kind = source.schema["id"].dataType.simpleString()
    width = (1 << BITS) // owners + 1

    def read(batches):
        known = suspect = back = None
        seq = 0
        for b in sliced(batches, "text"):
            part = b.column("part")[0].as_py()
            if back is None:
                back = received(answers, part, ["owner", "n", "bits", "unary", "rest", "twice"])
                got = sorted(back.rows.to_pylist(), key=lambda r: r["owner"])
                known = np.concatenate([np.zeros(0, np.uint64)] + [golomb_decode(r["n"], r["bits"], r["unary"], r["rest"]) + np.uint64(r["owner"] * width) for r in got])
                suspect = np.concatenate([np.zeros(0, bool)] + [np.unpackbits(np.frombuffer(r["twice"], np.uint8), count=r["n"]).astype(bool) for r in got])
            back.seen(b.column("mark"))
            texts = _stripped(b.column("text"))
            prints = _fingerprints(texts)
            at = np.searchsorted(known, prints)
            if len(known) == 0 or (known[np.minimum(at, len(known) - 1)] != prints).any():
                raise RuntimeError(sidefiles.MOVED)
            groups: dict[bytes, list] = {}
            chars, ids = _lengths(b.column("text")), b.column("id")
            for i in np.flatnonzero(suspect[at]).tolist():
                doc = ids[i].as_py()
                order = (-chars[i], doc is None, doc if doc is not None else 0, seq + i)
                held = groups.get(texts[i])
                if held is None:
                    groups[texts[i]] = [order, doc, 1]
                else:
                    held[2] += 1
                    if order < held[0]:
                        held[:2] = order, doc
            rows = list(groups.items())
            yield pa.RecordBatch.from_pydict({
                "body": pa.array([t for t, _ in rows], pa.binary()), "chars": pa.array([-h[0][0] for _, h in rows], pa.int64()),
                "id": pa.array([h[1] for _, h in rows], ids.type), "part": pa.array([part] * len(rows), pa.int32()),
                "seq": pa.array([h[0][3] for _, h in rows], pa.int64()), "n": pa.array([h[2] for _, h in rows], pa.int64())})
            seq += len(texts)
        if back:
            back.check()

    return source.mapInArrow(read, f"body binary, chars long, id {kind}, part int, seq long, n long")


def decisions(docs: DataFrame, id_col: str, text_col: str, owners: int | None = None) -> DataFrame:
    """One row per input row: ``part, seq`` (its place), ``id, keep_id, group_size, kept, sha``.

    ``owners`` is the number of hash ranges, by default the session's shuffle partitions.
    """
    spark = docs.sparkSession
    owners = owners or int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = _input(docs, id_col, text_col)
    path = new_folder(spark, "dedup-first")
    first = _first_pass(source, owners)
    first.write.partitionBy("kind").parquet(path)
    both = spark.read.schema(first.schema).parquet(path)
    notes = both.where("kind = 'note'").select(*[c.split()[0] for c in _NOTE.split(", ")])
    rows = both.where("kind = 'row'").select("part", "seq", "id", "sha")
    answers = send_back(notes.groupBy("owner").applyInPandas(_answer, _NOTE), "dedup-answers", proof(rows))
    suspects = _suspects(source, answers, owners)
    best = F.struct((-F.col("chars")).alias("less"), F.col("id").isNull().alias("none"), "id", "part", "seq")
    groups = (suspects.groupBy("body").agg(F.min(best).alias("best"), F.sum("n").alias("size"))
              .where("size > 1").select(F.sha2("body", 256).alias("sha"), "best", "size"))
    kept = F.col("best").isNull() | ((F.col("best.part") == F.col("part")) & (F.col("best.seq") == F.col("seq")))
    return (rows.join(groups, "sha", "left")
            .select("part", "seq", "id", F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
                    F.coalesce("size", F.lit(1).cast("long")).alias("group_size"), kept.alias("kept"), "sha"))


def drop_rows(docs: DataFrame, judged: DataFrame, id_col: str) -> DataFrame:
    """``docs`` without the rows that ``judged`` drops; no text is shuffled.

    ``judged`` has ``part, seq, id, dropped`` of every row. The rows read must be those judged, at the same places.
    """
    judged = written(judged.select("part", "seq", "id", "dropped"), "judged")
    path = send_back(judged.where("dropped").select("part", "seq"), "dropped", proof(judged))
    names, schema = docs.columns, docs.schema
    numbered = docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumns({
        "part": F.spark_partition_id(), "mark": sidefiles.mark(sidefiles.seq(), F.col(f"c{names.index(id_col)}"))})

    def read(batches):
        back, seq = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            if back is None:
                back = received(path, b.column(len(names))[0].as_py(), ["seq"])
                gone = np.sort(back.rows.column("seq").to_numpy())
            back.seen(b.column(len(names) + 1))
            stays = np.ones(b.num_rows, bool)
            a, z = np.searchsorted(gone, [seq, seq + b.num_rows])
            stays[gone[a:z] - seq] = False
            seq += b.num_rows
            yield pa.RecordBatch.from_arrays(b.columns[:len(names)], names).filter(pa.array(stays))
        if back:
            back.check()

    return numbered.mapInArrow(read, T.StructType(schema.fields))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    return drop_rows(docs, decisions(docs, id_col, text_col).withColumn("dropped", ~F.col("kept")), id_col)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decisions(table(spark, sf_dir, "documents"), "doc_id", "text")
    return d.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


OP10_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""
