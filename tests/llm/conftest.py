import random

import pytest
from pyspark.sql import types as T

WORDS = ["the", "harbour", "winter", "boats", "ice", "spring", "people", "town", "remember", "year", "house", "travellers", "Café", "naïve", "2024", "well,", "end."]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(400)) * (r.random() < 0.5) for _ in range(n))


BASE = prose(1, 120)
#: (doc_id, text): nulls, empty and blank, short, ties, repeated rows, copies up to white space, near copies, a very long text, other scripts
MESSY = [
    (1, BASE), (2, BASE + "\n"), (3, BASE.replace(" ", "  ", 3)), (3, BASE.replace(" ", "  ", 3)), (4, None), (5, ""), (6, " \t\n"), (7, "one two"), (8, "one  two"),
    (9, BASE + " tail one"), (10, "head " + BASE), (None, "no id here but some words"), (None, BASE), (11, prose(2, 30_000)), (12, "данные и слова"), (13, "<|endoftext|> a.b,c ... ×÷ É́"),
    (14, prose(3, 200)), (15, prose(3, 200)), (16, prose(3, 190) + " " + prose(4, 10)), (17, prose(5, 5)), (18, prose(5, 4)), (-5, prose(5, 5).upper()), (19, "x" * 5000), (20, "12 34 !!"),
]
#: names that the operators use inside
CLASHES = ["id", "part", "seq", "place", "kind", "sha", "share", "body", "n", "__text", "c0", "class", "unit", "ids", "__part", "lang_pred", "score"]


def frame(spark, rows, parts=3):
    """Documents with many extra columns whose names clash."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           *[T.StructField(c, T.StringType()) for c in CLASHES]])
    langs = ["en", "de", None]
    return spark.createDataFrame([(i, t, langs[k % 3], *["x"] * len(CLASHES)) for k, (i, t) in enumerate(rows)], schema).repartition(parts)


@pytest.fixture(scope="session")
def files(spark, tmp_path_factory):
    """Writes a frame to Parquet and reads it back: operators that read twice need stable partitions."""
    def write(df):
        path = str(tmp_path_factory.mktemp("t") / "t.parquet")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    return write


@pytest.fixture(scope="session")
def messy(spark, files):
    return files(frame(spark, MESSY))


@pytest.fixture(scope="session")
def empty(spark, files):
    return files(frame(spark, [], 1))
