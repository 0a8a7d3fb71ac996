"""Shared intermediate tables.

A lineage is cut by writing a Parquet table below ``spark.checkpoint.dir`` and reading it again, so a lost
executor never loses intermediate results. A folder of this machine is used only in local mode with the
setting unset (tests); a cluster without the setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors and the driver share: ``spark.checkpoint.dir`` of the session."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="tallyspark-llm-")
    return _local[app]


def file_system(path: str):
    """File system and path of an address, for driver and tasks alike."""
    import pyarrow.fs as fs

    if "://" not in path:
        path = f"file://{path.removeprefix('file:')}"
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and return the table read back from there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names for working columns that clash with none of ``df`` (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def of_process(name: str, make):
    """A value kept by this Python worker process from task to task (a cache; it may be lost at any time)."""
    import sys
    import types

    kept = sys.modules.setdefault("_tallyspark_llm_kept", types.ModuleType("_tallyspark_llm_kept")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def release(keep: bool = False) -> None:
    """Give unused memory of this worker process back to the system after a batch; without ``keep`` also what
    ``of_process`` holds, so that one operator's cache does not stay beside the next one's arrays."""
    import ctypes
    import sys

    import pyarrow as pa

    if not keep:
        sys.modules.pop("_tallyspark_llm_kept", None)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
