"""What executors share with the driver: the package's source, and tables that cut a lineage."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path
from typing import Any

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
#: On a folder of plain files (file://), each file that Hadoop writes costs a process that changes its mode, and a second one for a file of checksums. Nobody reads
#: these, nor the mark of success. Other stores do not know the first two settings.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true", "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


class Scope:
    """What a run has written to the shared folder and sent to the executors, to be given back when its result has been used."""

    def __init__(self) -> None:
        self.tables: list[tuple[SparkSession, str]] = []
        self.sent: list[Broadcast] = []

    def release(self) -> None:
        tables, sent = self.tables, self.sent
        self.tables, self.sent = [], []
        _OPEN.discard(self)
        for x in sent:
            x.unpersist()
        for spark, path in tables:
            if spark.sparkContext._jsc is not None:
                release(spark, path)


_ALL = Scope()
#: What goes when the driver ends.
_OPEN: set[Scope] = set()
_SCOPE: contextvars.ContextVar[Scope] = contextvars.ContextVar("scope", default=_ALL)


@contextlib.contextmanager
def scoped(scope: Scope | None = None) -> Iterator[Scope]:
    """Tables and broadcasts made inside belong to the scope that is given out. The caller releases it."""
    scope = scope or Scope()
    _OPEN.add(scope)
    token = _SCOPE.set(scope)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)


@contextlib.contextmanager
def passing() -> Iterator[Scope]:
    """A scope that is released at its end, also after an error: for work whose results are written elsewhere."""
    with scoped() as scope:
        try:
            yield scope
        finally:
            scope.release()


def adopt(scope: Scope) -> None:
    """What belongs to scope belongs to the current one from now on."""
    mine = _SCOPE.get()
    mine.tables += scope.tables
    mine.sent += scope.sent
    scope.tables, scope.sent = [], []
    _OPEN.discard(scope)


def broadcast(spark: SparkSession, value: Any) -> Broadcast:
    """A broadcast of the current scope. Released, it is fetched again where it is still needed."""
    out = spark.sparkContext.broadcast(value)
    _SCOPE.get().sent.append(out)
    return out


def ship(spark: SparkSession) -> None:
    """Makes this package importable in Python workers of executors that do not share the driver's disk."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix=f"{top.name}-src-")
    target = os.path.join(folder, f"{top.name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
    atexit.register(shutil.rmtree, folder, True)


def shared_root(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local one is set only where that is unset and driver and executors are one process (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        local = tempfile.mkdtemp(prefix="folioflow-")
        atexit.register(shutil.rmtree, local, True)
        sc.setCheckpointDir(f"file://{local}")
    return sc.getCheckpointDir()


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, for a store of several tables. It goes with its scope, or when the driver ends."""
    path = f"{shared_root(spark)}/folioflow/{name}-{uuid.uuid4().hex}"
    _SCOPE.get().tables.append((spark, path))
    return path


def write_table(df: DataFrame, name: str) -> str:
    """Writes df as Parquet under the shared folder and returns its path. It goes with its scope, or when the driver ends."""
    path = folder(df.sparkSession, name)
    df.write.options(**PLAIN_FILES).parquet(path)
    return path


def materialize(df: DataFrame, name: str, rows: int | None = None, file_rows: int = 100_000) -> DataFrame:
    """Cuts the lineage: a lost executor costs a read of Parquet, not the whole job again.

    rows: a bound of df's rows, where it is known and the last step of df is light; no more files are written than that asks for.
    """
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // file_rows)))
    return df.sparkSession.read.schema(df.schema).parquet(write_table(df, name))


def release(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _release_all() -> None:
    for scope in [*_OPEN, _ALL]:
        try:
            scope.release()
        except Exception:  # noqa: BLE001 - the gateway may be gone already
            return
