import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

from aerostat.llm import packing as pk
from aerostat.llm.wordtok import WordTokenizer, default_path


def test_every_id_lies_in_one_piece(messy):
    out = pk.pack_texts(messy, "doc_id", "text").collect()
    tok = WordTokenizer(default_path()).tok
    want = sorted(np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for r in messy.collect())
    texts, at = [], {}
    for r in out:
        at.setdefault(r.sequence_id, []).append(r)
    # pieces of one text share id and total; rebuild by following starts within equal keys
    rest = sorted(out, key=lambda r: (str(r.id), r.total, r.start))
    open_texts = {}
    for r in rest:
        key = (r.id, r.total)
        bodies = open_texts.setdefault(key, [])
        for i, b in enumerate(bodies):
            if len(b) == 4 * r.start:
                bodies[i] = b + r.ids
                break
        else:
            assert r.start == 0
            bodies.append(r.ids)
    texts = sorted(b for bs in open_texts.values() for b in bs)
    assert texts == want
    for seq in at.values():
        seq.sort(key=lambda r: r.offset)
        end = 0
        for r in seq:
            assert r.offset == end and r.length * 4 == len(r.ids) and r.length > 0
            end += r.length
        assert end <= pk.MAX_TOKENS and len(seq) <= pk.MAX_SEGMENTS
        assert end == pk.MAX_TOKENS or end & (end - 1) == 0 or len(seq) == pk.MAX_SEGMENTS


def test_digest_and_empty(messy, empty):
    d = pk.digest(pk.pack_texts(messy, "doc_id", "text"))
    assert d.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    crcs = sorted(r.ids_crc32 for r in d.collect())
    assert crcs == sorted(zlib.crc32(r.ids) for r in pk.pack_texts(messy, "doc_id", "text").collect())
    assert pk.digest(pk.pack_texts(empty, "doc_id", "text")).count() == 0


def test_same_rows_when_run_again(messy):
    p = pk.digest(pk.pack_texts(messy, "doc_id", "text"))
    assert sorted(map(str, p.collect())) == sorted(map(str, p.collect()))


examples = st.lists(st.tuples(st.integers(0, 60), st.integers(-2, 70)), max_size=60)
limits = st.builds(pk.Limits, st.integers(1, 40), st.integers(1, 6), st.integers(1, 40))


@settings(max_examples=60, deadline=None)
@given(examples, limits, st.booleans(), st.integers(1, 9))
def test_limits_hold_and_nothing_is_lost(items, lim, cut, pool):
    packer = pk.VectorPacker(lim, cut, True, pool)
    rows = [(k, n, m) for k, (n, m) in enumerate(items)]
    pieces = [*packer.add(rows), *packer.finish()]
    need = {k: (n, min(n, max(0, m))) for k, n, m in rows if n}
    seen, bins = {}, {}
    for key, start, length, seq, offset, fits in pieces:
        assert start == seen.get(key, 0)
        seen[key] = start + length
        n, m = need[key]
        loss = max(0, start + length - max(start, n - m))
        tokens, segments, total, ok = bins.get(seq, (0, 0, 0, True))
        assert offset == tokens
        bins[seq] = tokens + length, segments + 1, total + loss, ok and fits
        if not cut:
            assert length == n
    assert seen == {k: n for k, (n, _) in need.items()}
    for tokens, segments, loss, fits in bins.values():
        assert not fits or (tokens <= lim.tokens and segments <= lim.segments and loss <= lim.loss)
        assert fits or (segments == 1 and not cut)


def test_pack_examples_frame(spark):
    df = spark.createDataFrame([("a", 5, 2, 1), ("b", None, None, 1), ("c", 3, 3, 2), (None, 4, 0, 2), ("c", 3, 3, 2), ("big", 99, 9, 1)], "name string, n int, loss int, id int")
    out = pk.pack_examples(df, "name", "n", "loss", pk.Limits(8, 2, 4)).collect()
    assert sorted((r.id or "", r.length, r.fits) for r in out) == [("", 4, True), ("a", 5, True), ("big", 99, False), ("c", 3, True), ("c", 3, True)]


def test_dot_product_prefers_what_fills_the_room():
    packer = pk.VectorPacker(pk.Limits(10, 3, 10), cut=False)
    out = [*packer.add([("s", 2, 2), ("l", 8, 8), ("m", 5, 5)]), *packer.finish()]
    assert [(k, s) for k, _, _, s, _, _ in out] == [("l", 0), ("s", 0), ("m", 1)]


def test_short_examples_wait_for_more_tokens():
    packer = pk.VectorPacker(pk.Limits(), cut=True, tail_powers=True)
    pieces = [*packer.add([(i, 3, 3) for i in range(300)]), *packer.add([(1000 + i, 4096, 4096) for i in range(5)]), *packer.finish()]
    total: dict = {}
    for _, _, length, number, _, _ in pieces:
        total[number] = total.get(number, 0) + length
    assert sum(total.values()) == 300 * 3 + 5 * 4096
    assert sum(n == 4096 for n in total.values()) == 5 and all(n & (n - 1) == 0 for n in total.values())
