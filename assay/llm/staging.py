"""Written tables in the shared scratch folder: they cut lineage, survive the
loss of executors and can be read by any of them."""

from __future__ import annotations

import ctypes
import io
import sys
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from assay.session import checkpoint_dir

_made: list[str] = []


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def mark() -> int:
    """A point in time for :func:`release`."""
    return len(_made)


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Delete the tables that this process staged after the mark ``since``, but
    for the last ``keep`` of them; call it once the results that read them are
    written.  Returns their number."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    old = _made[since:len(_made) - keep]
    del _made[since:len(_made) - keep]
    n = 0
    for name in old:
        path = jvm.org.apache.hadoop.fs.Path(name)
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the Python workers import this package wherever they run: a zip of
    its sources in the shared folder, added once to the application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent).as_posix())
    to = f"{checkpoint_dir(spark).rstrip('/')}/llm/{root.name}-{uuid.uuid4().hex}.zip"
    path = sc._jvm.org.apache.hadoop.fs.Path(to)
    store = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = store.create(path)
    out.write(bytearray(data.getvalue()))
    out.close()
    sc.addPyFile(store.makeQualified(path).toString())
    _shipped.add(sc.applicationId)


#: Operators that keep tables in a worker process from task to task; each has a ``forget``.
REMEMBERING = ("bpe", "pieces", "langid")


def hold(own: str = "") -> None:
    """Called in a worker process when a task begins: the tables of other
    operators go, so that a process that serves several stages holds those of
    one at a time, and memory that earlier tasks have freed goes back to the
    system."""
    for name in REMEMBERING:
        module = sys.modules.get(f"{__package__}.{name}")
        if module is not None and name != own:
            module.forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # glibc has it
    if trim is not None:
        trim(0)
