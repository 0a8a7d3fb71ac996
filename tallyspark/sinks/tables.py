"""Materializations on parquet directories.

Plain parquet has no row-level MERGE/DELETE, so upserts are expressed as
relational plans over the touched partitions:

* the batch's partition values (one per day in a lookback window) are met with
  the table's partition directories; only the touched directories are read and
  listed, the rest of the table is neither read nor rewritten;
* the batch is staged once to the shared checkpoint folder (it is read by
  the conflict check, the partition list and the merge), cutting its lineage
  to the sources;
* ``target ⋉̸ batch ∪ batch`` (left anti join on the keys) is written whole
  beside the table, with a manifest of the old files it replaces; only then
  are the new files moved in and the old ones deleted. A crash at any step is
  rolled forward from the manifest by the next writer, so kept rows always
  exist in one complete copy.

Unpartitioned targets (the small model outputs) are rebuilt into a fresh
directory, marked ready and swapped in by rename; an unfinished swap is known
by its ready copy alone, so a dropped table never comes back. One writer per
table is assumed. Between the two renames readers use the ready copy; while
files move in, a reader of a partitioned table may see old and new rows.

A batch may lack columns of the table (they become NULL in its rows); a batch
with columns that the table lacks is an error.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyspark.operators import upsert
from tallyspark.operators.joins import bounded_broadcast
from tallyspark.session import scratch_dir


# ---------------------------------------------------------------- file-system helpers

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _glob(spark: SparkSession, pattern: str) -> list:
    fs, _, jvm = _fs(spark, pattern)
    return list(fs.globStatus(jvm.org.apache.hadoop.fs.Path(pattern)) or [])


def _current(spark: SparkSession, path: str) -> str | None:
    """Where the table is: its path, or between the two renames of a swap its ready copy."""
    fs, p, _ = _fs(spark, path)
    if fs.exists(p):
        return path
    ready = _glob(spark, f"{path}.__ready-*")
    return str(ready[0].getPath()) if ready else None


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when the table, or the complete copy of an unfinished swap, is there. Changes nothing."""
    return _current(spark, path) is not None


def recover(spark: SparkSession, path: str) -> None:
    """Finish what a writer that died had begun (called by the next writer).

    A ready copy is swapped in, a manifest's files are moved in; whatever was
    not complete yet is removed. Old copies without a ready copy are leftovers.
    """
    fs, p, jvm = _fs(spark, path)
    for st in _glob(spark, f"{path}.__ready-*"):
        _swap_ready(spark, str(st.getPath()), path)
    for st in _glob(spark, f"{path}.__part-*"):
        if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), MANIFEST)):
            _move_in(spark, str(st.getPath()), path)
        else:
            fs.delete(st.getPath(), True)
    for kind in ("old", "staging"):
        for st in _glob(spark, f"{path}.__{kind}-*"):
            fs.delete(st.getPath(), True)


def _swap_ready(spark: SparkSession, ready: str, path: str) -> None:
    """Replace ``path`` by the complete copy ``path.__ready-id``; may be called again after a crash."""
    fs, dst, jvm = _fs(spark, path)
    old = jvm.org.apache.hadoop.fs.Path(ready.replace(".__ready-", ".__old-"))
    if fs.exists(dst) and not fs.rename(dst, old):
        raise IOError(f"could not move {path} aside")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(ready), dst):
        raise IOError(f"could not move {ready} to {path}")
    fs.delete(old, True)


MANIFEST = "_manifest"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all; one of the same name is replaced."""
    fs, to, jvm = _fs(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(to.getParent(), f"_{to.getName()}.draft")
    stream = fs.create(draft, True)
    stream.write(text.encode())
    stream.close()
    fs.delete(to, False)
    if not fs.rename(draft, to):
        raise IOError(f"could not write {path}")


def literal_path(uri: str) -> str:
    """A file's URI as a path that is read as it stands: decoded, without pattern characters."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(uri))


def _names(spark: SparkSession, directory: str) -> list[str]:
    """Names in a directory, hidden ones left out; a few calls however many there are."""
    fs, p, jvm = _fs(spark, directory)
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(p))
    # "{directory/name,directory/name}" of the qualified directory
    text = jvm.org.apache.commons.lang3.ArrayUtils.toString(paths)[1:-1]
    names = text.split(f"{fs.makeQualified(p).toString().rstrip('/')}/")[1:]
    names = [n.removesuffix(",") for n in names[:-1]] + names[-1:]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def _is_partition(name: str) -> bool:
    return "=" in name and not name.endswith(".parquet")


def _files(spark: SparkSession, directory: str) -> list[str]:
    """Data files of a directory and of its partition directories (listed, not read)."""
    out = []
    for name in _names(spark, directory):
        path = f"{directory}/{name}"
        out += _files(spark, path) if _is_partition(name) else [path]
    return out


def _each(act: Callable[[str], None], items: Sequence[str]) -> None:
    """File operations, many at a time: on remote storage each one waits."""
    if len(items) < 4:
        for x in items:
            act(x)
        return
    with ThreadPoolExecutor(16) as pool:
        for _ in pool.map(act, items):
            pass


def _move_in(spark: SparkSession, staged: str, path: str) -> None:
    """Move the files of a complete staged copy into the table, then delete the files its manifest names.

    File names are unique, so every step may be repeated after a crash.
    """
    fs, root, jvm = _fs(spark, staged)
    new = [f[len(staged) + 1:] for f in _files(spark, staged)]
    for d in sorted({f.rpartition("/")[0] for f in new}):
        fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{path}/{d}" if d else path))

    def move(f: str) -> None:
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(f"{staged}/{f}"), jvm.org.apache.hadoop.fs.Path(f"{path}/{f}")):
            raise IOError(f"could not move {staged}/{f} to {path}")

    _each(move, new)
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(root, MANIFEST))
    try:
        old = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    _each(lambda f: fs.delete(jvm.org.apache.hadoop.fs.Path(f), False), [f for f in old.split("\n") if f])
    fs.delete(root, True)


def _bring_in(new: DataFrame, old: Sequence[str], path: str, partition_by: Sequence[str] | None,
              sort_within: Sequence[str] | None = None, as_dealt: bool = False) -> str:
    """Add the rows of ``new`` to the table in place of the files ``old`` (``as_dealt``: keep its partitioning)."""
    spark = new.sparkSession
    staged = f"{path}.__part-{uuid.uuid4().hex[:8]}"
    writer = new.write.partitionBy(*partition_by) if as_dealt else _writer(new, partition_by, sort_within)
    writer.parquet(staged)
    write_text(spark, f"{staged}/{MANIFEST}", "\n".join(old))
    _move_in(spark, staged, path)
    spark.catalog.refreshByPath(path)
    return path


def read_stored(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a stored table; with ``schema`` partition columns keep their declared types
    and the columns come back in the declared order (a partitioned read puts
    partition columns last)."""
    path = _current(spark, path) or path
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def _writer(df: DataFrame, partition_by: Sequence[str] | None, sort_within: Sequence[str] | None):
    """DataFrameWriter for a table layout.

    Partitioned writes are rebalanced on the partition columns first: AQE then
    coalesces small output partitions and splits a hot one over several
    tasks, so each partition gets a few files near the advisory size instead
    of one small file per upstream task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


# ---------------------------------------------------------------- K1 / K7 / K9

def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                sort_within: Sequence[str] | None = None) -> str:
    """K1 full rebuild: write to a staging directory, then swap it in.

    Readers see either the old or the new table, never a partial one (with
    ``read_stored``, which also finds the table between the two renames).
    ``partition_by`` gives the hive layout (K7); ``sort_within`` orders rows
    inside each output file (K9; row order is not part of the result).
    """
    spark = df.sparkSession
    staged = f"{path}.__staging-{uuid.uuid4().hex[:8]}"
    _writer(df, partition_by, sort_within).mode("errorifexists").parquet(staged)
    fs, src, jvm = _fs(spark, staged)
    ready = staged.replace(".__staging-", ".__ready-")
    if not fs.rename(src, jvm.org.apache.hadoop.fs.Path(ready)):
        raise IOError(f"could not move {staged} to {ready}")
    _swap_ready(spark, ready, path)
    spark.catalog.refreshByPath(path)
    return path


#: The directory value of a NULL partition.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _partition_dirs(spark: SparkSession, path: str, depth: int) -> list[tuple[str, tuple]]:
    """(directory, its partition values as texts, None for NULL) of a table with ``depth`` partition columns."""
    found = [(path, ())]
    for _ in range(depth):
        deeper = []
        for d, values in found:
            for name in _names(spark, d):
                if _is_partition(name):
                    value = unquote(name.split("=", 1)[1])
                    deeper.append((f"{d}/{name}", (*values, None if value == NULL_PARTITION else value)))
        found = deeper
    return found


def _touched_dirs(spark: SparkSession, path: str, parts: DataFrame, partition_by: Sequence[str],
                  count: str | None = None) -> dict[str, int]:
    """The table's partition directories whose values are among the rows of ``parts`` (NULL is a value like others),
    each with the largest ``count`` of its rows there.

    The directory names, cast to the columns' types, are met with the distinct values in Spark, so neither the
    number of values nor how a name is written matters, and no row of the table is read.
    """
    dirs = _partition_dirs(spark, path, len(partition_by))
    if not dirs:
        return {}
    names = [f"_p_{c}" for c in partition_by]
    listed = spark.createDataFrame([(i, *values) for i, (_, values) in enumerate(dirs)],
                                   ", ".join(["_dir int", *[f"`{n}` string" for n in names]]))
    listed = bounded_broadcast(listed, len(dirs))
    named, cond = parts.groupBy(*partition_by).agg(F.max(F.col(count) if count else F.lit(1)).alias("_most")), None
    for c, n in zip(partition_by, names):
        same = listed[n].cast(parts.schema[c].dataType).eqNullSafe(named[c])
        cond = same if cond is None else cond & same
    return {dirs[i][0]: most for i, most in named.join(listed, cond).select("_dir", "_most").collect()}


def _read_dirs(spark: SparkSession, path: str, dirs: Sequence[str], schema: StructType) -> DataFrame:
    """The rows of some partition directories of a table, in the declared column order."""
    if not dirs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*dirs).select(*schema.fieldNames())


def _first_file(spark: SparkSession, directory: str) -> str | None:
    for name in _names(spark, directory):
        path = f"{directory}/{name}"
        found = _first_file(spark, path) if _is_partition(name) else path
        if found:
            return found
    return None


def _stored_schema(spark: SparkSession, path: str) -> StructType:
    """The columns of a stored table, from one of its files."""
    one = _first_file(spark, path)
    return spark.read.option("basePath", path).parquet(one).schema if one else read_stored(spark, path).schema


def _aligned(batch: DataFrame, stored: StructType, path: str) -> DataFrame:
    """The batch with all columns of the table; its own types stay."""
    extra = [c for c in batch.columns if c not in stored.fieldNames()]
    if extra:
        raise ValueError(f"{path} has no column {', '.join(extra)}; rebuild it with a full refresh")
    for f in stored.fields:
        if f.name not in batch.columns:
            batch = batch.withColumn(f.name, F.lit(None).cast(f.dataType))
    return batch


def _stage(df: DataFrame, partition_by: Sequence[str] | None, name: str) -> tuple[DataFrame, str]:
    """Materialize ``df`` under the shared checkpoint folder; returns (reader, path)."""
    spark = df.sparkSession
    stage = scratch_dir(spark, name)
    _writer(df, partition_by, None).parquet(stage)
    return read_stored(spark, stage, df.schema), stage


def _drop_stage(spark: SparkSession, stage: str | None) -> None:
    """Remove a staged copy once the write that read it has committed."""
    if stage:
        fs, p, _ = _fs(spark, stage)
        fs.delete(p, True)


def _upsert(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
            partition_by: Sequence[str] | None, target_pred: Column | None,
            check_conflicts: bool, sort_within: Sequence[str] | None) -> str:
    recover(spark, path)
    if not table_exists(spark, path):
        return write_table(batch, path, partition_by, sort_within)
    batch = _aligned(batch, _stored_schema(spark, path), path)
    stage = None
    if check_conflicts or partition_by:
        # The batch is read more than once (conflict check, partition list,
        # merge): stage it so its source scan runs once and later steps never
        # recompute it from upstream.
        batch, stage = _stage(batch, None, "batch-stage")
    try:
        dirs: Sequence[str] = []
        repeated = None
        if partition_by and set(partition_by) <= set(keys):
            # one pass over the batch tells the touched directories and whether a key is repeated in one of them
            counted = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if check_conflicts else batch
            found = _touched_dirs(spark, path, counted, partition_by, "_n" if check_conflicts else None)
            dirs, repeated = list(found), any(n > 1 for n in found.values())
        elif partition_by:
            # a matched row may lie in another partition than its new version
            whole = read_stored(spark, path, batch.schema)
            parts = batch.select(*partition_by).unionByName(
                whole.join(batch.select(*keys).distinct(), list(keys), "left_semi").select(*partition_by))
            dirs = list(_touched_dirs(spark, path, parts, partition_by))
        scope = _read_dirs(spark, path, dirs, batch.schema) if partition_by else read_stored(spark, path, batch.schema)
        if check_conflicts:
            # repeated batch keys are rare; only if there are any does the target matter
            if repeated is None:
                twice = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
                repeated = not twice.isEmpty()
            if repeated:
                bad = upsert.merge_conflicts(scope, batch, keys, target_pred).limit(1).collect()
                if bad:
                    raise ValueError(f"merge: several batch rows match one target row for key {bad[0].asDict()}")
        merged = upsert.merge(scope, batch, keys, target_pred) if dirs or not partition_by else batch
        if partition_by:
            return _bring_in(merged, [f for d in dirs for f in _files(spark, d)], path, partition_by, sort_within)
        return write_table(merged, path, partition_by, sort_within)
    finally:
        _drop_stage(spark, stage)


def write_merge(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                partition_by: Sequence[str] | None = None, target_pred: Column | None = None,
                sort_within: Sequence[str] | None = None, batch_keys_unique: bool = False) -> str:
    """K3 (+K6): upsert on ``keys``; raises when two batch rows match one target row.

    ``batch_keys_unique`` skips that check (one job) when the batch is grouped
    on the key, so no key can occur twice.
    """
    return _upsert(spark, path, batch, keys, partition_by, target_pred, not batch_keys_unique, sort_within)


def write_delete_insert(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                        partition_by: Sequence[str] | None = None, target_pred: Column | None = None,
                        sort_within: Sequence[str] | None = None) -> str:
    """K4 (+K6): delete target rows whose key is in the batch, insert the whole batch."""
    return _upsert(spark, path, batch, keys, partition_by, target_pred, False, sort_within)


def write_append_new(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                     partition_by: Sequence[str] | None = None, target_pred: Column | None = None) -> str:
    """K5: append only batch rows whose key is not in the target window (first write wins).

    The new rows are written beside the table and come in by a manifest without old files: a writer that died is
    rolled forward, so a batch is never there in part. Replaying the same batch appends nothing.
    """
    recover(spark, path)
    if not table_exists(spark, path):
        return write_table(batch, path, partition_by)
    batch = _aligned(batch, _stored_schema(spark, path), path)
    stage = None
    try:
        if partition_by and set(partition_by) <= set(keys):
            batch, stage = _stage(batch, None, "append-stage")
            target = _read_dirs(spark, path, list(_touched_dirs(spark, path, batch, partition_by)), batch.schema)
        else:
            target = read_stored(spark, path, batch.schema)
        new = upsert.new_rows(target, batch, keys, target_pred)
        return _bring_in(new.select(*batch.columns), [], path, partition_by)
    finally:
        _drop_stage(spark, stage)


# ---------------------------------------------------------------- K10

TARGET_FILE_BYTES = 128 * 1024 * 1024


def file_counts(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files per partition directory (file listing only, no data read)."""
    counts: dict[str, int] = {}
    for f in read_stored(spark, path).inputFiles():
        d = f.rsplit("/", 1)[0]
        counts[d] = counts.get(d, 0) + 1
    return counts


def partition_stats(spark: SparkSession, path: str, depth: int,
                    keep: Callable[[tuple], bool] | None = None) -> dict[tuple, tuple[int, int]]:
    """(partition values) -> (data files, bytes) from the file system.

    Directory names are listed once; ``keep`` picks partitions by their values
    (texts, ``NULL_PARTITION`` for NULL) before any per-partition size call, so a
    post-write compaction looks only at the partitions it just wrote.
    """
    return {values: stats for _, values, stats in _stats(spark, path, depth, keep)}


def _stats(spark, path, depth, keep) -> list[tuple[str, tuple, tuple[int, int]]]:
    fs, _, jvm = _fs(spark, path)
    out = []
    for d, values in _partition_dirs(spark, path, depth):
        values = tuple(NULL_PARTITION if v is None else v for v in values)
        if keep is None or keep(values):
            cs = fs.getContentSummary(jvm.org.apache.hadoop.fs.Path(d))
            out.append((d, values, (int(cs.getFileCount()), int(cs.getLength()))))
    return out


def compact(spark: SparkSession, path: str, partition_by: Sequence[str] | None = None,
            min_files: int = 2, target_file_bytes: int = TARGET_FILE_BYTES,
            schema: StructType | None = None, keep: Callable[[tuple], bool] | None = None) -> int:
    """Rewrite partitions that have ``min_files`` or more files and more than they need.

    A rewritten partition gets ``ceil(bytes / target_file_bytes)`` files;
    rows are spread over them by a hash of the whole row, so a partition
    holding a large share of the table is written by several tasks, not one.
    A partition at its file count stays, so a second call rewrites nothing.
    Untouched partitions are neither read nor rewritten.
    ``keep`` limits the partitions examined (by their string values).
    Returns the number of partitions rewritten.
    """
    df = read_stored(spark, path, schema)
    recover(spark, path)
    if not partition_by:
        fs, p, _ = _fs(spark, path)
        size, n = int(fs.getContentSummary(p).getLength()), len(_files(spark, path))
        if n < min_files or n <= max(1, -(-size // target_file_bytes)):
            return 0
        write_table(df.repartition(max(1, -(-size // target_file_bytes))), path)
        return 1
    plan, at, rows = [], 0, []
    for d, values, (n, size) in _stats(spark, path, len(partition_by), keep):
        parts = max(1, -(-size // target_file_bytes))
        if n >= min_files and n > parts:
            plan.append(d)
            rows.append((*[None if v == NULL_PARTITION else v for v in values], parts, at))
            at += parts
    if not plan:
        return 0
    # one file for each (partition, part): numbered files, each the task of its own number
    names = [f"_p_{c}" for c in partition_by]
    layout = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names) + ", _parts long, _first long")
    layout = bounded_broadcast(layout, len(rows))
    scope = _read_dirs(spark, path, plan, df.schema)
    cond = None
    for c, n in zip(partition_by, names):
        same = scope[c].eqNullSafe(layout[n].cast(df.schema[c].dataType))
        cond = same if cond is None else cond & same
    part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.col("_parts"))
    numbered = scope.join(layout, cond).withColumn("_file", (F.col("_first") + part).cast("int"))
    dealt = numbered.repartitionById(at, "_file").select(*df.columns)
    _bring_in(dealt, [f for d in plan for f in _files(spark, d)], path, partition_by, as_dealt=True)
    return len(plan)
