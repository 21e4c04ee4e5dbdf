"""N-gram Jaccard join: MinHash banding, then exact verification.

Texts are sets of five-word shingles; two texts are linked when the Jaccard similarity of their sets is
at least the threshold (0.8).

1. Texts with the same shingle set are one unit (they are linked, and have the same other links).
2. Units that agree in all minima of one of ``TREES`` bands are candidates. This is banding in place of an LSH forest:
   the length of the bands is one number, the longest up to ``MAX_DEPTH`` with which a pair at the threshold meets in some
   band with probability ``RECALL``; it does not depend on the data. Where no length reaches it, there is an error.
3. Candidates' components (not pairs) say which sets have to meet. Their sets, read in a second pass
   over the input, are brought together once; a component with many sets is split into blocks, and every
   pair of blocks is a group of its own, so no task holds more than two blocks.
4. Within a group the intersections of all sets are counted exactly (rare shingles by their few pairs,
   the others by a matrix product); only counts of links and one edge per unit leave the task.

The result has a row per document with its class (the component over links) and its number of links.

Cases: a null or empty text has no shingle, no link and a class of its own; one of fewer than five words
has one shingle of all its words; repeated rows are copies of each other and linked; null ids keep their
rows, a class's name being its smallest id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from aerostat.llm.common import release, sliced, table, written
from aerostat.llm.components import connected
from aerostat.llm.exact_dedup import drop_rows
from aerostat.llm.shingles import MinHash, mix, series, text_shingles
from aerostat.llm import sidefiles
from aerostat.llm.sidefiles import proof, received, send_back

SHINGLE, THRESHOLD = 5, 0.8
TREES, MAX_DEPTH, RECALL = 32, 8, 0.99999
#: a block of a component: at most about so many shingles, and so many sets
BLOCK_SHINGLES, BLOCK_SETS = 1 << 21, 3000
#: shingles in at most so many sets of a group are counted pair by pair, the others by a matrix product
RARE = 8


def prefix_depth(threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL, deepest: int = MAX_DEPTH) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree with probability ``recall``."""
    depth = deepest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def _places(source: DataFrame, trees: int, depth: int, k: int) -> DataFrame:
    """Per text its place, number of shingles, 128-bit name of its set, and its path in each tree."""
    kind = source.schema["id"].dataType.simpleString()
    salts = series(trees, 31)

    def read(batches):
        release()
        hasher, seq = MinHash(trees * depth), 0
        for b in sliced(batches, "text"):
            part, n = b.column("part")[0].as_py(), b.num_rows
            place = [(part << 40) + seq + i for i in range(n)]
            seq += n
            sets = text_shingles(b.column("text").to_pylist(), k)
            one, two, paths = [], [], []
            for p, s in zip(place, sets):
                if not len(s):
                    one.append(p), two.append(-1), paths.append([])
                    continue
                one.append(int(s.sum(dtype=np.uint64).astype(np.int64)))
                two.append(int(mix(s ^ salts[0]).sum(dtype=np.uint64).astype(np.int64)))
                path = salts.copy()
                for step in hasher.signature(s).reshape(depth, trees):
                    path = mix(path ^ step)
                paths.append(path.astype(np.int64))
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part] * n, pa.int32()), "place": pa.array(place, pa.int64()), "id": b.column("id"),
                "n": pa.array([len(s) for s in sets], pa.int64()), "one": pa.array(one, pa.int64()), "two": pa.array(two, pa.int64()),
                "paths": pa.array(paths, pa.list_(pa.int64()))})

    return source.mapInArrow(read, f"part int, place long, id {kind}, n long, one long, two long, paths array<long>")


def _numbered(rows: DataFrame) -> DataFrame:
    """With the rows' numbers within their partitions."""
    return rows.withColumn("seq", F.col("place") - F.shiftleft(F.col("part").cast("long"), 40))


def _sets(source: DataFrame, wanted: str, k: int) -> DataFrame:
    """Second pass: the shingle sets of the wanted units, once for each pair of blocks that needs them."""
    def read(batches):
        back, seq = None, 0
        for b in sliced(batches, "text"):
            part = b.column("part")[0].as_py()
            if back is None:
                back = received(wanted, part, ["unit", "root", "copies", "blocks", "block", "one"])
                rows = {r["unit"] - (part << 40): r for r in back.rows.to_pylist()}
            back.seen(b.column("mark"))
            hits = [i for i in range(b.num_rows) if seq + i in rows]
            texts = b.column("text").take(pa.array(hits, pa.int64())).to_pylist()
            out = {c: [] for c in ("root", "i", "j", "side", "unit", "copies", "shingles")}
            for i, s in zip(hits, text_shingles(texts, k)):
                r = rows[seq + i]
                if int(s.sum(dtype=np.uint64).astype(np.int64)) != r["one"]:
                    raise RuntimeError(sidefiles.MOVED)
                body = s.tobytes()
                for other in range(r["blocks"]):
                    for c, v in zip(out.values(), (r["root"], min(r["block"], other), max(r["block"], other), r["block"], r["unit"], r["copies"], body)):
                        c.append(v)
            seq += b.num_rows
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out.values(), kinds)], list(out))
        if back:
            back.check()

    return source.mapInArrow(read, "root long, i int, j int, side int, unit long, copies long, shingles binary")


def linked(sets: list[np.ndarray], left: int, threshold: float) -> np.ndarray:
    """Which of the first ``left`` sets link to which of the others (``left`` = 0: all to all, symmetric)."""
    count = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    doc = np.repeat(np.arange(count), sizes)
    _, at, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(at, kind="stable")
    doc, df_of = doc[order], df[at[order]]
    rows, cols = (left, count - left) if left else (count, count)
    common = np.zeros((rows, cols), np.float32)

    def add(a, b):  # one shared shingle for each pair a < b
        if left:
            ok = (a < left) & (b >= left)
            np.add.at(common, (a[ok], b[ok] - left), 1)
        else:
            np.add.at(common, (a, b), 1)
            np.add.at(common, (b, a), 1)
    for d in range(2, RARE + 1):
        group = doc[df_of == d].reshape(-1, d)
        for x in range(d):
            for y in range(x + 1, d):
                add(group[:, x], group[:, y])
    many = df_of > RARE
    doc, at = doc[many], np.unique(at[order][many], return_inverse=True)[1]
    for low in range(0, int(at.max()) + 1 if len(at) else 0, 1024):
        a, z = np.searchsorted(at, [low, low + 1024])
        dense = np.zeros((count, 1024), np.float32)
        dense[doc[a:z], at[a:z] - low] = 1
        common += dense[:left] @ dense[left:].T if left else dense @ dense.T
    both = (sizes[:left, None] + sizes[None, left:]) if left else sizes[:, None] + sizes[None, :]
    link = common >= threshold * (both - common) - 1e-6 * both
    link &= common > 0
    if not left:
        np.fill_diagonal(link, False)
    return link


def lowest(link: np.ndarray) -> np.ndarray:
    """Of a symmetric link matrix, per row the smallest row of its component."""
    label, big = np.arange(len(link)), len(link)
    while True:
        new = np.minimum(label, np.where(link, label[None, :], big).min(axis=1, initial=big))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _group(rows: list[tuple], threshold: float) -> tuple[list[int], list[int], list[int]]:
    """Units with links, their weighted number of links, and the smallest unit of their part of the group."""
    rows.sort(key=lambda r: (r[3], r[4]))
    sets = [np.frombuffer(r[6], np.uint64) for r in rows]
    unit = np.array([r[4] for r in rows], np.int64)
    copies = np.array([r[5] for r in rows], np.int64)
    left = sum(r[3] == rows[0][1] for r in rows) if rows[0][1] != rows[0][2] else 0
    if rows[0][1] != rows[0][2]:
        if left in (0, len(rows)):
            return [], [], []
        part = linked(sets, left, threshold)
        links = np.concatenate([part @ copies[left:], copies[:left] @ part])
        full = np.zeros((len(rows), len(rows)), bool)
        full[:left, left:], full[left:, :left] = part, part.T
    else:
        full = linked(sets, 0, threshold)
        links = full @ copies
    has = links > 0
    low = np.minimum.reduceat(unit[np.argsort(label := lowest(full), kind="stable")], np.searchsorted(np.sort(label), np.unique(label)))
    name = low[np.searchsorted(np.unique(label), label)]
    return unit[has].tolist(), links[has].tolist(), name[has].tolist()


def _verified(sets: DataFrame, threshold: float) -> DataFrame:
    """All groups' links; the rows of a group come together by a hash of its key and stream through in order."""
    def read(batches):
        key, held = None, []
        out = [[], [], [], []]

        def close():
            if len(held) > 1:
                for c, v in zip(out, _group(held, threshold)):
                    c.extend(v)
                out[3].extend([held[0][2] > 0] * (len(out[0]) - len(out[3])))
            held.clear()

        def batch():
            got = pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                                              pa.array(out[3], pa.bool_())], ["unit", "links", "low", "split"])
            for c in out:
                c.clear()
            return got
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if row[:3] != key:
                    close()
                    key = row[:3]
                held.append(row)
            yield batch()
        close()
        yield batch()

    # a wide salt of (root, i, j) alone decides the task; many small groups share one
    return (sets.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
            .mapInArrow(read, "unit long, links long, low long, split boolean"))


def similarity_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    shingle: int = SHINGLE, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """Per row of ``docs`` ``part, place, id, class_id, n_links, first`` (whether it is its class's first row).

    Aggregates that are joined back to the rows of their key are written first: both sides of the join are
    then shuffled for it, and Spark can split a hot key's rows.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.spark_partition_id().alias("part"),
                         sidefiles.mark(sidefiles.seq(), F.col(id_col)).alias("mark"))
    depth = prefix_depth(threshold, trees, recall)
    if 1 - (1 - threshold**depth) ** trees < recall:
        raise ValueError(f"{trees} trees cannot reach a recall of {recall} at similarity {threshold}")
    signed = written(_places(source, trees, depth, shingle), "join-signed")
    units = written(signed.groupBy("one", "two").agg(F.min("place").alias("unit"), F.count("*").alias("copies")), "join-units")
    rows = written(signed.select("part", "place", "id", "n", "one", "two").join(units, ["one", "two"]), "join-rows")

    own = rows.where("place = unit").select("unit", "part", "n", "copies", "one")
    paths = written(signed.join(own.select(F.col("unit").alias("place")), "place", "left_semi")
                    .select(F.col("place").alias("unit"), F.explode("paths").alias("path")), "join-paths")
    meet = written(paths.groupBy("path").agg(F.min("unit").alias("v"), F.count("*").alias("k")).where("k > 1").drop("k"), "join-meet")
    roots = connected(paths.join(meet, "path").select(F.col("unit").alias("u"), "v"), "join-candidates")

    roots = written(roots.union(roots.select(F.col("root").alias("u"), "root").distinct()).withColumnRenamed("u", "unit").join(own, "unit"), "join-wanted")
    size = roots.groupBy("root").agg(F.sum("n").alias("all"), F.count("*").alias("sets"))
    blocks = F.greatest(F.ceil(F.col("all") / BLOCK_SHINGLES), F.ceil(F.col("sets") / BLOCK_SETS)).cast("int")
    wanted = (roots.join(size, "root").withColumn("blocks", blocks)
              .withColumn("block", F.pmod(F.xxhash64("unit"), F.col("blocks")).cast("int"))
              .select("part", "unit", "root", "copies", "blocks", "block", "one"))
    found = written(_verified(_sets(source, send_back(wanted, "join-sent", proof(_numbered(signed))), shingle), threshold), "join-links")

    label = found.groupBy("unit").agg(F.sum("links").alias("links"), F.min("low").alias("low"), F.max("split").alias("split"))
    if not found.where("split").isEmpty():
        over = connected(found.where("split").select(F.col("unit").alias("u"), F.col("low").alias("v")), "join-split")
        label = (label.join(over.withColumnRenamed("u", "unit"), "unit", "left")
                 .select("unit", "links", F.coalesce("root", F.when(F.col("split"), F.col("unit")).otherwise(F.col("low"))).alias("low")))
    named = (rows.join(label.select("unit", "links", "low"), "unit", "left")
             .select("part", "place", "id", F.coalesce("low", "unit").alias("class"),
                     (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    named = written(named, "join-named")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "place")).alias("first")
    return (named.join(written(named.groupBy("class").agg(first), "join-classes"), "class")
            .select("part", "place", "id", F.col("first.id").alias("class_id"), "n_links", (F.col("first.place") == F.col("place")).alias("first")))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class (the smallest id), all columns as they were."""
    joined = similarity_join(docs, id_col, text_col, **options)
    return drop_rows(docs, _numbered(joined).withColumn("dropped", ~F.col("first")), id_col)


def op3_similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its class of near copies and its number of links."""
    joined = similarity_join(table(spark, sf_dir, "documents"))
    return joined.select(F.col("id").alias("doc_id"), "class_id", "n_links")
