"""SentencePiece encoding by a batched Viterbi in numpy, and decoding.

The model file gives pieces and scores. A text is normalised as the file says, its spaces become the
mark U+2581, and it is cut into units (marks and what follows them, and line ends); no piece crosses a
unit's start, else the whole text is one unit. Units of equal length advance together: for each end
position and piece length the polynomial hashes of all units' substrings probe the sorted keys of the
pieces of that length (after a bit table that sorts out most of those that are no piece), and the
maxima over the lengths, longest first, store the back pointers. A character that no
single-character piece covers costs 10 more than the worst piece and comes out as its byte pieces (or as the
unknown id, if the file has none). Each result is compared with its unit; a hash collision would be
seen there and is then solved by plain comparison of strings.

Cases: a null text gives null ids, an empty one no ids; very long words are cut into no windows and are solved
whole; decoding skips control ids and raises on ids beyond the file; repeated rows are treated alike; empty tables
give no rows; columns beside those named are kept as they are by :func:`encode` and :func:`decode`.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from aerostat.llm.common import resident, sliced, table

MARK = "▁"
#: units whose ids a Python worker keeps
CACHE_UNITS = 250_000
#: rows that decoding works on at once
DECODE_ROWS = 500
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNKNOWN_COST = 10.0
_UNITS = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
_BITS = np.uint64(64 - 18)  # of a key, for the bit tables


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def worker_pieces(path: str) -> "Pieces":
    return resident(("pieces", path), lambda: Pieces(path))


class Pieces:
    """A model file's pieces; the library is used to read the file and to normalise texts."""

    def __init__(self, path: str):
        import sentencepiece
        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.lib.get_piece_size()
        names = [self.lib.id_to_piece(i) for i in range(n)]
        self.bytes_id = {int(names[i][3:5], 16): i for i in range(n) if self.lib.is_byte(i)}
        self.unknown = self.lib.unk_id()
        normal = [i for i in range(n) if not (self.lib.is_byte(i) or self.lib.is_control(i) or self.lib.is_unknown(i) or self.lib.is_unused(i))]
        self.score = {names[i]: self.lib.get_score(i) for i in normal}
        self.id_of = {names[i]: i for i in normal}
        self.unknown_score = min(self.score.values()) - _UNKNOWN_COST
        self.by_unit = not any(MARK in p.lstrip(MARK) or "\n" in p for p in self.score)
        self.text = names
        self.out = [b"" if self.lib.is_control(i) else b"\xe2\x81\x87" if i == self.unknown else names[i].encode() for i in range(n)]
        for b, i in self.bytes_id.items():
            self.out[i] = bytes([b])
        #: per piece length: sorted hash keys, scores, ids, bit table
        self.tables: dict[int, tuple[np.ndarray, ...]] = {}
        for length in sorted({len(p) for p in self.score}):
            own = [p for p in self.score if len(p) == length]
            keys = self._prefix(_points(own, length))[-1]
            order = np.argsort(keys)
            bits = np.zeros(1 << 18, bool)
            bits[keys >> _BITS] = True
            self.tables[length] = (keys[order], np.array([self.score[own[i]] for i in order]), np.array([self.id_of[own[i]] for i in order], np.int32), bits)
        self.cache: dict[str, bytes] = {}

    @staticmethod
    def _prefix(points: np.ndarray) -> np.ndarray:
        """Hashes of all prefixes of equally long strings: row i has those of i characters."""
        out = np.zeros((points.shape[1] + 1, len(points)), np.uint64)
        for i in range(points.shape[1]):
            out[i + 1] = out[i] * _BASE + points[:, i].astype(np.uint64) + np.uint64(1)
        return out

    def viterbi(self, units: list[str]) -> list[list[int]]:
        """Best ids of equally long units; an uncovered character comes out as -1."""
        n, m = len(units[0]), len(units)
        hashes = self._prefix(_points(units, n))
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(self.tables), _BASE)]), dtype=np.uint64)
        best = np.full((n + 1, m), -np.inf)
        best[0] = 0
        length_at, id_at = np.zeros((n + 1, m), np.int32), np.full((n + 1, m), -1, np.int32)
        lengths = sorted(self.tables, reverse=True)
        for end in range(1, n + 1):
            top, covered = best[end], np.zeros(m, bool)
            for length in [x for x in lengths if x <= end]:
                keys, scores, ids, bits = self.tables[length]
                key = hashes[end] - hashes[end - length] * power[length]
                rows = np.flatnonzero(bits[key >> _BITS])
                key = key[rows]
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                rows, at = rows[hit], at[hit]
                if length == 1:
                    covered[rows] = True
                total = best[end - length][rows] + scores[at]
                better = total > top[rows]
                rows = rows[better]
                top[rows], length_at[end][rows], id_at[end][rows] = total[better], length, ids[at[better]]
            total = best[end - 1] + self.unknown_score  # the character alone, unknown
            rows = np.flatnonzero(~covered & (total > top))
            top[rows], length_at[end][rows], id_at[end][rows] = total[rows], 1, -1
        out: list[list[int]] = [[] for _ in units]
        at, rows = np.full(m, n), np.arange(m)
        while len(rows):
            for i, piece in zip(rows.tolist(), id_at[at[rows], rows].tolist()):
                out[i].append(piece)
            at[rows] -= length_at[at[rows], rows]
            rows = rows[at[rows] > 0]
        return [ids[::-1] for ids in out]

    def _plain(self, unit: str) -> list[int]:
        """The same maximum by plain comparison of strings."""
        best, back = [0.0] + [-np.inf] * len(unit), [(0, -1)] * (len(unit) + 1)
        for end in range(1, len(unit) + 1):
            for length in [x for x in sorted(self.tables, reverse=True) if x <= end]:
                piece = unit[end - length:end]
                if piece in self.score and best[end - length] + self.score[piece] > best[end]:
                    best[end], back[end] = best[end - length] + self.score[piece], (length, self.id_of[piece])
            if unit[end - 1] not in self.score and best[end - 1] + self.unknown_score > best[end]:
                best[end], back[end] = best[end - 1] + self.unknown_score, (1, -1)
        out, at = [], len(unit)
        while at:
            out.append(back[at][1])
            at -= back[at][0]
        return out[::-1]

    def _finish(self, unit: str, ids: list[int]) -> bytes:
        """Uncovered characters as bytes; neighbours that stay unknown are one id, as in the library."""
        if -1 not in ids:
            return array("I", ids).tobytes()
        out, at = [], 0
        for piece in ids:
            if piece >= 0:
                at += len(self.text[piece])
                out.append(piece)
            elif self.bytes_id:
                out.extend(self.bytes_id[b] for b in unit[at].encode())
                at += 1
            else:
                if not (out and out[-1] == self.unknown):
                    out.append(self.unknown)
                at += 1
        return np.array(out, "<u4").tobytes()

    def _fits(self, unit: str, ids: list[int]) -> bool:
        if -1 not in ids:
            return "".join([self.text[i] for i in ids]) == unit
        at = 0
        for piece in ids:
            text = unit[at] if piece < 0 else self.text[piece]
            if not unit.startswith(text, at):
                return False
            at += len(text)
        return at == len(unit)

    def units(self, text: str) -> list[str]:
        text = self.lib.normalize(text) if text else ""
        return (_UNITS.findall(text) if self.by_unit else [text]) if text else []

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        """Ids as little-endian 32-bit integers."""
        split = [None if t is None else self.units(t) for t in texts]
        new = set().union(*[u for u in split if u]).difference(self.cache)
        if len(self.cache) + len(new) > CACHE_UNITS:
            self.cache.clear()
            new = set().union(*[u for u in split if u])
        by_length: dict[int, list[str]] = {}
        for unit in new:
            by_length.setdefault(len(unit), []).append(unit)
        for n, same in by_length.items():
            step = max(1, 400_000 // (n + 1))
            for at in range(0, len(same), step):
                part = same[at:at + step]
                for unit, ids in zip(part, self.viterbi(part)):
                    self.cache[unit] = self._finish(unit, ids if self._fits(unit, ids) else self._plain(unit))
        get = self.cache.__getitem__
        return [None if u is None else b"".join(map(get, u)) for u in split]

    def decode(self, ids: list[int]) -> str:
        text = b"".join([self.out[i] for i in ids]).decode("utf-8", "replace").replace(MARK, " ")
        return text.removeprefix(" ")


def _points(strings: list[str], n: int) -> np.ndarray:
    return np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(strings), n)


def encode(df: DataFrame, text_col: str, out_col: str = "ids", model: str | None = None) -> DataFrame:
    """``df`` with the ids of ``text_col`` as ``array<int>``."""
    path, names = model or default_path(), df.columns
    at = names.index(text_col)
    source = df.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("text", F.col(f"c{at}").cast("string"))

    def run(batches):
        live = worker_pieces(path)
        for b in sliced(batches, "text"):
            raw = live.encode(b.column("text").to_pylist())
            ends = np.concatenate([[0], np.cumsum([len(r or b"") // 4 for r in raw])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join([r or b"" for r in raw]), "<i4")),
                                             mask=pa.array([r is None for r in raw]))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], lists], [*b.schema.names[:-1], "ids"])

    return source.mapInArrow(run, source.drop("text").schema.add("ids", T.ArrayType(T.IntegerType()))).toDF(*names, out_col)


def decode(df: DataFrame, ids_col: str, out_col: str = "decoded", model: str | None = None) -> DataFrame:
    """``df`` with the text of the ids in ``ids_col``; null ids give null."""
    path, names = model or default_path(), df.columns
    at = names.index(ids_col)
    source = df.toDF(*[f"c{i}" for i in range(len(names))])

    def run(batches):
        live = worker_pieces(path)
        for b in (whole.slice(i, DECODE_ROWS) for whole in batches for i in range(0, whole.num_rows, DECODE_ROWS)):
            texts = [live.decode(r.values.to_numpy(zero_copy_only=False).tolist()) if r.is_valid else None for r in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, "decoded"])

    return source.mapInArrow(run, T.StructType([*source.schema.fields, T.StructField("decoded", T.StringType())])).toDF(*names, out_col)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and whether decoding gives its text again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = decode(encode(docs, "text"), "ids")
    return both.select("doc_id", F.size("ids").alias("n_ids"), "ids", F.col("decoded").eqNullSafe(F.col("text")).alias("restored"))
