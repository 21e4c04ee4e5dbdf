"""A later pass that does not see the rows the places were named for fails; it never gives another result."""

import pytest

from aerostat.llm import common, exact_dedup as ed, similarity_join as sj, warc
from tests.llm.conftest import BASE, prose


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "docs.parquet")
    rows = [(i, BASE if i % 3 == 0 else prose(i, 150)) for i in range(240)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(12).write.parquet(path)
    return path


@pytest.fixture()
def layout(spark):
    """Deals the input's files to partitions in another way."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")

    def change():
        spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield change
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


@pytest.mark.parametrize("run", [ed.deduplicate, sj.keep_first], ids=["exact", "similar"])
def test_a_changed_layout_fails_instead_of_dropping_other_rows(spark, docs, layout, run):
    df = spark.read.parquet(docs)
    planned = run(df)
    want = sorted(r.doc_id for r in run(df).collect())
    layout()
    with pytest.raises(Exception, match="other partitions"):
        planned.collect()
    assert sorted(r.doc_id for r in run(spark.read.parquet(docs)).collect()) == want  # a run of its own is fine with any layout


def test_an_unseen_folder_is_an_error(spark, docs):
    df = spark.read.parquet(docs)
    planned = ed.drop_rows(df, ed.decisions(df, "doc_id", "text").selectExpr("part", "seq", "id", "NOT kept AS dropped").where("part < 0"), "doc_id")
    with pytest.raises(Exception, match="can be seen"):  # nothing was sent at all, as where tasks look at another store
        planned.collect()


def test_the_shared_folder_is_named_as_spark_resolves_it(spark):
    assert common.shared_folder(spark).startswith("file:///")


def test_a_cut_archive_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://a/{i}", "<p>" + "x" * 50 * i) for i in range(50)], "page_id long, url string, html string")
    path = str(tmp_path / "pages.parquet")
    pages.coalesce(1).write.parquet(path)
    folder = common.new_folder(spark, "warc-test")
    listed = warc.write_warc(spark.read.parquet(path), folder, shards=1).collect()
    assert warc.read_warc(spark, folder).count() == 50
    name = f"{folder[7:]}/{listed[0].file}"
    with open(name, "rb") as f:
        data = f.read()
    ends = [i for i in range(len(data)) if data[i:i + 3] == b"\x1f\x8b\x08"]
    with open(name, "wb") as f:
        f.write(data[:ends[10]])  # a clean cut between two records
    with pytest.raises(Exception, match="manifest lists"):
        warc.read_warc(spark, folder).count()
