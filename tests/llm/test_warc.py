import hashlib
import os

import pytest

from aerostat.llm import warc
from aerostat.llm.common import new_folder

BIG, OTHER = "<p>é</p>" * 200, "<p>o</p>" * 200
PAGES = [(1, "http://a/1", BIG), (9, "http://a/9", BIG), (4, None, BIG), (4, None, BIG), (2, "http://b\r\nX: y", None), (3, "", ""), (None, "http://n", OTHER), (5, "http://s", "small"), (6, "http://s", "small"),
         (7, "http://é", "x" * 300_000), (None, None, BIG), (8, "u", "a\r\n\r\nb" * 250)]


@pytest.fixture(scope="module")
def pages(spark, files):
    df = spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, place string, page string")
    return files(df.repartition(3))


def test_round_trip(spark, pages):
    folder = new_folder(spark, "warc-test")
    manifest = warc.write_warc(pages, folder, shards=3, roll=2000)
    back = warc.read_warc(spark, folder).collect()
    assert len(back) == len(PAGES) == sum(r.records for r in manifest.collect())
    want = sorted((str(i), len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest()) for i, _, h in PAGES)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in back) == want
    big = [r for r in back if r.payload_digest == hashlib.sha1(BIG.encode()).hexdigest()]
    assert sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in big) == sorted(
        [("9", "response", "None"), ("1", "revisit", "9"), ("4", "revisit", "9"), ("4", "revisit", "9"), ("None", "revisit", "9")])
    assert all(r.record_type == "response" and r.refers_to is None for r in back if r not in big)
    assert sorted(r.payload.decode() for r in back if r.payload is not None and r not in big) == sorted(h or "" for _, _, h in PAGES if h != BIG)
    assert {r.url for r in back if r.page_id in (2, 7, 1)} == {"http://b%0D%0AX: y", "http://é", "http://a/1"}


def test_files_are_listed_rolled_ordered_and_the_same_again(spark, pages):
    kept = []
    for _ in range(2):
        folder = new_folder(spark, "warc-test")
        rows = warc.write_warc(pages, folder, shards=2, roll=700).collect()
        path = folder.removeprefix("file://")
        names = {f for f in os.listdir(path) if f.endswith(".warc.gz")}
        assert names == {r.file for r in rows} and os.listdir(f"{path}/_temporary") == [] and len(rows) > 2
        for r in rows:
            data = open(f"{path}/{r.file}", "rb").read()
            assert len(data) == r.bytes and hashlib.sha1(data).hexdigest() == r.sha1
        kept.append(sorted(map(str, rows)))
        ids = [r.first_id for r in sorted(rows, key=lambda r: r.file) if r.first_id is not None]
        assert ids == sorted(ids)
    assert kept[0] == kept[1]


def test_the_same_bytes_however_the_input_is_dealt(spark, files):
    copies = [(20, "http://c", OTHER)] * 25 + [(21, None, "tiny")] * 12 + [(30 + i, f"http://p/{i}", f"<p>{i}</p>" * 20) for i in range(40)]
    rows = [(*p, "x", "y") for p in [*PAGES, *copies]]
    schema, kept = "page_id long, url string, html string, place string, page string", []
    for n, order in ((1, rows), (4, rows[::-1]), (7, rows[::3] + rows[1::3] + rows[2::3])):
        folder = new_folder(spark, "warc-test")
        made = warc.write_warc(files(spark.createDataFrame(order, schema).repartition(n)), folder, shards=5, roll=2000).collect()
        kept.append(sorted(tuple(r) for r in made))
        path = folder.removeprefix("file://")
        ids = [warc.parse(m)[0]["WARC-Record-ID"] for r in made for m in warc.members(open(f"{path}/{r.file}", "rb"))]
        assert len(ids) == len(set(ids)) == len(rows)
    assert kept[0] == kept[1] == kept[2]
    assert len({r[0][:11] for r in kept[0]}) == 5  # no range is empty, and the group of 25 equal rows is cut


def test_what_lost_attempts_left_goes_with_the_commit(spark, pages):
    folder = new_folder(spark, "warc-test")
    path = folder.removeprefix("file://")
    os.makedirs(f"{path}/_temporary")
    open(f"{path}/_temporary/lost-part-000000-00000.warc.gz", "wb").write(b"half")
    warc.write_warc(pages, folder, shards=2)
    assert os.listdir(f"{path}/_temporary") == []


def test_a_cut_file_is_an_error(spark, pages):
    folder = new_folder(spark, "warc-test")
    names = [r.file for r in warc.write_warc(pages, folder, shards=1).collect()]
    path = f"{folder.removeprefix('file://')}/{names[0]}"
    data = open(path, "rb").read()
    open(path, "wb").write(data[:data.index(b"\x1f\x8b\x08", 10)])  # whole records, but not all
    with pytest.raises(Exception, match="not the file that the manifest lists"):
        warc.read_warc(spark, folder).collect()


def test_damage_is_an_error(spark, pages):
    with pytest.raises(ValueError):
        warc.parse(warc.record(1, 0, "u", 3, hashlib.sha1(b"abc").hexdigest(), b"abc", None, None).replace(b"abc", b"abd"))
    with pytest.raises(ValueError):
        warc.parse(b"nothing\r\n\r\n")


def test_unlisted_files_do_not_count(spark, pages):
    folder = new_folder(spark, "warc-test")
    n = warc.write_warc(pages, folder).count()
    open(f"{folder.removeprefix('file://')}/part-999999-00000.warc.gz", "wb").write(b"junk")
    assert n >= 1 and warc.read_warc(spark, folder, payloads=False).count() == len(PAGES)


def test_empty(spark, pages):
    folder = new_folder(spark, "warc-test")
    assert warc.write_warc(pages.limit(0), folder).count() == 0 and warc.read_warc(spark, folder).count() == 0
