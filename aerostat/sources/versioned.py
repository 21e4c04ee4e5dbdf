"""Versioned tables: immutable Parquet files, one commit record per version, readers see one version whole.

    <path>/data/commit=<id>/<partition>=<value>/...   files of one commit, never changed afterwards
    <path>/log/<version>.json                         schema, and for each partition the commit that holds it
    <path>/refs/<name>                                a frozen snapshot: the number of a version

A commit writes the partitions it touches once, into a folder of its own, and becomes visible by its record
alone. Records are written beside and renamed to their final name without overwriting, so of two writers
that start from one version the second one fails, reads the first one's version and merges anew. A crash at any
step leaves the older version as it was; what it leaves behind is unreferenced and goes with :func:`vacuum`.
(Rename without overwrite is atomic on HDFS-like stores; on a store without it, use one writer per table.)

A partition's rows are merged by aggregates as everywhere; the record holds a line per partition, so partition
by something like the day. Rows with a NULL partition value have a partition of their own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from aerostat.operators.incremental import dedup_keep_first, keep_latest, merge_by_order, upsert_latest
from aerostat.sources.store import remove

TRIES = 8  # of a writer that finds its version taken


def _path(spark: SparkSession, path: str):
    """The qualified Hadoop path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(p), fs


def _names(spark: SparkSession, folder: str) -> list[str]:
    p, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file whole, or not at all if it exists; False if it does."""
    target, fs = _path(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}.tmp")
    stream = fs.create(beside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    options = spark._jvm.org.apache.hadoop.fs.Options
    never = spark.sparkContext._gateway.new_array(options.Rename, 1)
    never[0] = options.Rename.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(beside, target, never)
        return True
    except Py4JJavaError as e:
        fs.delete(beside, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise


def _log(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/log/{version:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    return [int(n[:-5]) for n in _names(spark, f"{path.rstrip('/')}/log") if n.endswith(".json") and not n.startswith(".")]


def record(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The commit record of a version, by default the newest; None for a table without one."""
    if version is None:
        found = versions(spark, path)
        if not found:
            return None
        version = found[-1]
    return json.loads(_read_text(spark, _log(path, version)))


def frame(spark: SparkSession, path: str, rec: dict) -> DataFrame:
    """The rows of a commit record's partitions."""
    schema = T.StructType.fromJson(rec["schema"])
    data = f"{path.rstrip('/')}/data"
    folders = [f"{data}/commit={commit}/{name}" for name, commit in sorted(rec["parts"].items())]
    if not folders:
        return spark.createDataFrame([], schema)
    full = T.StructType([*[f for f in schema.fields if f.name != rec["partition"]], T.StructField("commit", T.StringType()), schema[rec["partition"]]])
    return spark.read.schema(full).option("basePath", data).parquet(*folders).select(*schema.names)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version (the newest at the time of the call), whatever is committed later."""
    rec = record(spark, path, version)
    if rec is None:
        raise FileNotFoundError(f"no version of {path}")
    return frame(spark, path, rec)


def commit(spark: SparkSession, path: str, rows: DataFrame, partition_col: str, base: dict | None,
           meta: dict | None = None) -> int | None:
    """Write ``rows`` as the whole content of the partitions they are in and commit; None if the version was taken.

    ``meta`` (JSON values) is added to what the record before it holds, and becomes visible with the rows or not at all.
    """
    root, number = path.rstrip("/"), (base["version"] if base else 0) + 1
    made = uuid.uuid4().hex
    folder = f"{root}/data/commit={made}"
    rows.hint("rebalance", partition_col).write.partitionBy(partition_col).parquet(folder)
    parts = dict(base["parts"]) if base else {}
    parts |= {name: made for name in _names(spark, folder) if name.startswith(f"{partition_col}=")}
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields])
    text = json.dumps({"version": number, "partition": partition_col, "schema": schema.jsonValue(), "parts": parts,
                       "meta": {**(base or {}).get("meta", {}), **(meta or {})}})
    if create_once(spark, _log(root, number), text):
        return number
    remove(spark, folder)
    return None


def upsert(spark: SparkSession, path: str, new: DataFrame, key: Sequence[str], order: Sequence[str] = (), partition_col: str = "date",
           resolve: str = "new", ts: str | None = None) -> int:
    """Keyed insert as one commit; returns the version that holds it (the newest one if ``new`` is empty, 0 for none).

    Keys are resolved as in :func:`aerostat.sources.store.upsert_table`, inside the partitions that ``new`` touches.
    """
    if ts is not None and ts not in key:
        raise ValueError(f"the key {list(key)} does not fix the partition: it lacks {ts}")
    touched = [r[0] for r in new.select(partition_col).distinct().collect()]  # a value per partition, as the record has
    for _ in range(TRIES):
        base = record(spark, path)
        if not touched:
            return base["version"] if base else 0
        if base is None:
            merged = dedup_keep_first(new, key, order) if resolve == "first" else keep_latest(new, key, order) if order else new.dropDuplicates(list(key))
        else:
            here = F.col(partition_col).isin([v for v in touched if v is not None])
            old = frame(spark, path, base).filter(here | F.col(partition_col).isNull() if None in touched else here)
            incoming = new.select(*old.columns)
            merged = upsert_latest(old, incoming, key, order) if resolve == "new" else merge_by_order(old, incoming, key, order, resolve)
        done = commit(spark, path, merged, partition_col, base)
        if done is not None:
            return done
    raise RuntimeError(f"{path}: other writers committed {TRIES} times in a row")


def freeze(spark: SparkSession, path: str, name: str) -> int:
    """A snapshot: ``name`` points at the newest version from now on. A name that exists keeps its version."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no version of {path}")
    ref = f"{path.rstrip('/')}/refs/{name}"
    create_once(spark, ref, str(found[-1]))
    return int(_read_text(spark, ref))


def frozen(spark: SparkSession, path: str, name: str) -> DataFrame:
    return read(spark, path, int(_read_text(spark, f"{path.rstrip('/')}/refs/{name}")))


def vacuum(spark: SparkSession, path: str, keep: int = 2, orphans_before_ms: int | None = None) -> list[str]:
    """Remove what only versions before the last ``keep`` hold; snapshots stay. Returns the folders removed.

    Folders without any record (of a writer that crashed, or is at work) go only if they are older than ``orphans_before_ms``.
    """
    root, found = path.rstrip("/"), versions(spark, path)
    pinned = {int(_read_text(spark, f"{root}/refs/{n}")) for n in _names(spark, f"{root}/refs") if not n.startswith(".")}
    stay = set(found[-keep:]) | (pinned & set(found))
    used = {c for v in stay for c in record(spark, path, v)["parts"].values()}
    known = {c for v in found for c in record(spark, path, v)["parts"].values()}
    gone = []
    for name in _names(spark, f"{root}/data"):
        p, fs = _path(spark, f"{root}/data/{name}")
        orphan = name[7:] not in known and orphans_before_ms is not None and fs.getFileStatus(p).getModificationTime() < orphans_before_ms
        if name.startswith("commit=") and (orphan or name[7:] in known - used):
            remove(spark, f"{root}/data/{name}")
            gone.append(name)
    for v in set(found) - stay:
        remove(spark, _log(root, v))
    return gone


def register(spark: SparkSession, registry: str, model: str, metrics: dict[str, float], snapshot: str) -> int:
    """Claim the next version number of a model together with its metrics; two runs never get the same one."""
    folder = f"{registry.rstrip('/')}/{model}"
    while True:
        taken = [int(n[:-5]) for n in _names(spark, folder) if n.endswith(".json") and not n.startswith(".")]
        number = max(taken, default=0) + 1
        rows = [json.dumps({"model": model, "version": number, "metric": m, "value": float(v), "snapshot": snapshot}) for m, v in metrics.items()]
        if create_once(spark, f"{folder}/{number:09d}.json", "\n".join(rows)):
            return number


def registered(spark: SparkSession, registry: str) -> DataFrame:
    """All registered metrics: model, version, metric, value, snapshot."""
    return spark.read.schema("model string, version int, metric string, value double, snapshot string").json(f"{registry.rstrip('/')}/*/*.json")
