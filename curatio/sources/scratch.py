"""Scratch tables: written once to the folder that the cluster shares, and read back.

The folder is the one that the cluster names in ``spark.checkpoint.dir``; where it is unset and the master is
local (tests on one machine) a temporary folder is used, and on a cluster that is an error.  A scratch table cuts
lineage, so plans stay small and a lost executor costs a re-read of a table instead of a re-run of everything
before it.  The shuffle files behind a table are of no more use once it is written and go at once.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

_roots: dict[str, str] = {}
#: The tables that this driver has written and not removed: their paths, with their names where they have one.
_tables: dict[str, str | None] = {}
#: Whether shuffle files go when the query that wrote them ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """A folder of this session's own below spark.checkpoint.dir, removed when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = base or tempfile.mkdtemp(prefix="curatio-")
        _roots[app] = f"{base.rstrip('/')}/curatio-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, _roots[app])
    return _roots[app]


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session is gone already, and with it whoever could delete
        pass


def scratch(df: DataFrame, name: str, small: bool = False) -> DataFrame:
    """``df`` written once to the shared folder and read back; small: a table far smaller than the input, in fewer files."""
    if small:
        df = df.coalesce(max(1, partitions(df.sparkSession) // 16))
    path = _written(df, name, lambda writer, path: writer.parquet(path))
    _tables[path] = None
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, name: str, by: str, grouped: bool = False) -> DataFrame:
    """``df`` written once and read back, bucketed by a column: joins on it move only their other side, or neither if that
    is bucketed too.  grouped: df is the result of a grouping by that column, and lies in its partitions already."""
    n, table = partitions(df.sparkSession), f"{name}_{uuid.uuid4().hex[:12]}"
    path = _written(df if grouped else df.repartition(n, by), name, lambda writer, path: writer.format("parquet").bucketBy(n, by).sortBy(by).option("path", path).saveAsTable(table))
    _tables[path] = table
    return df.sparkSession.table(table)


def written() -> list[str]:
    """The scratch tables that there are, in the order of writing."""
    return list(_tables)


def clear(spark: SparkSession, before: list[str], keep: int = 1) -> None:
    """Removes the tables written since ``before`` but the last ``keep``: for operators whose result reads no others."""
    since = [path for path in _tables if path not in set(before)]
    for path in since[: len(since) - keep]:
        if table := _tables.pop(path):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        _remove(spark, path)


def _written(df: DataFrame, name: str, write: Callable[[DataFrameWriter, str], None]) -> str:
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    conf, before = df.sparkSession.conf, df.sparkSession.conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        # nobody waits for a table's mark of success: this driver reads it only when the write has returned
        write(df.write.option("compression", "zstd").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"), path)
    finally:
        conf.set(_CLEANUP, before)
    return path


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
