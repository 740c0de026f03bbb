"""A stored table with upserts: hash buckets, and a manifest that commits.

Rows live in ``data/_version=<version>/bucket=<n>``; a manifest names the version of
each bucket.  An upsert rewrites the buckets in which something changes under a
new version and commits by writing the next manifest; a reader that holds the
manifest before it keeps reading the files that it names, and files that a lost
job has left are named by none.  A batch carries an id: run again, it finds its
manifest and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ways to take an incoming row whose key is stored: as the modes of ``tenancy.upsert``.
MODES = ("ignore", "update", "overwrite")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def manifests(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete manifests, ascending."""
    p, fs = _fs(spark, f"{root}/manifest")
    if not fs.exists(p):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(p) if fs.exists(_fs(spark, f"{s.getPath()}/_SUCCESS")[0]))


def _manifest(spark: SparkSession, root: str, number: int) -> list:
    """``bucket, v, batch, buckets`` of a manifest: a row for each bucket."""
    return spark.read.schema("bucket int, v int, batch string, buckets int").parquet(f"{root}/manifest/{number}").collect()


def _commit(spark: SparkSession, root: str, number: int, versions: dict[int, int], batch: str, buckets: int) -> None:
    rows = [(b, v, batch, buckets) for b, v in sorted(versions.items())] or [(-1, -1, batch, buckets)]
    p, fs = _fs(spark, f"{root}/manifest/{number}")
    if fs.exists(p) and not fs.exists(_fs(spark, f"{root}/manifest/{number}/_SUCCESS")[0]):
        fs.delete(p, True)                                   # of a lost job
    spark.createDataFrame(rows, "bucket int, v int, batch string, buckets int").coalesce(1).write.mode("error").parquet(f"{root}/manifest/{number}")


def _write(rows: DataFrame, root: str, version: int) -> dict[int, int]:
    """``rows`` with ``_b``, their bucket, as files of a version, each bucket one task's."""
    spark, path = rows.sparkSession, f"{root}/data/_version={version}"
    rows.withColumnRenamed("_b", "_bucket").repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(path)
    p, fs = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return {int(n.split("=")[1]): version for n in names if n.startswith("_bucket=")}


def _rows(spark: SparkSession, root: str, versions: dict[int, int], like: DataFrame | None = None) -> DataFrame:
    paths = [f"{root}/data/_version={v}/_bucket={b}" for b, v in sorted(versions.items())]
    schema = spark.read.schema(f"{_schema(spark, root)}, _version int, _bucket int")
    if not paths:
        return spark.createDataFrame([], _schema(spark, root))
    return schema.option("basePath", f"{root}/data").parquet(*paths).drop("_version", "_bucket")


def _schema(spark: SparkSession, root: str) -> str:
    return spark.read.text(f"{root}/schema", wholetext=True).first()[0].strip()


def create(rows: DataFrame, root: str, key: str, buckets: int = 64, batch: str = "create") -> None:
    """Store a table; ``key`` is unique.  Choose ``buckets`` so that one, of
    1 / ``buckets`` of the rows, suits a task.  A table that is there stays."""
    spark = rows.sparkSession
    if manifests(spark, root):
        return
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    spark.createDataFrame([(ddl,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/schema")
    made = _write(rows.withColumn("_b", _bucket(key, buckets)), root, 0)
    _commit(spark, root, 0, made, batch, buckets)


def read(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The table as of a manifest, the last one by default."""
    number = manifests(spark, root)[-1] if number is None else number
    return _rows(spark, root, {r.bucket: r.v for r in _manifest(spark, root, number) if r.bucket >= 0})


def conflicts(new: DataFrame, key: str) -> DataFrame:
    """Keys of a batch with rows that differ (``key, n``), and null keys: none of their rows is taken."""
    kinds = new.groupBy(key).agg(F.count_distinct(F.struct(*[F.coalesce(F.to_json(F.struct(F.col(f"`{c}`"))), F.lit("")) for c in new.columns])).alias("n"))
    return kinds.where((F.col("n") > 1) | F.col(key).isNull())


def upsert(new: DataFrame, root: str, key: str, mode: str, batch: str) -> dict[str, int]:
    """Take a batch into the table; returns what it did, in numbers: ``buckets``
    rewritten, ``inserted``, ``updated``, ``conflicts`` (see :func:`conflicts`).

    ``ignore`` inserts new keys, ``update`` replaces stored ones, ``overwrite``
    does both.  A bucket in which no row changes keeps its files.  A batch id
    that a manifest names has been taken before: nothing is done.
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode!r}")
    spark = new.sparkSession
    known = manifests(spark, root)
    last = _manifest(spark, root, known[-1])
    if any(_manifest(spark, root, n)[0].batch == batch for n in reversed(known)):
        return {"buckets": 0, "inserted": 0, "updated": 0, "conflicts": 0}
    buckets, versions = last[0].buckets, {r.bucket: r.v for r in last if r.bucket >= 0}
    columns = [c for c in read(spark, root, known[-1]).columns if c != key]
    odd = conflicts(new, key)
    n_odd = odd.count()
    clean = new.select(key, *columns).where(F.col(key).isNotNull()).join(odd.select(key), key, "left_anti").distinct()
    clean = clean.select(key, F.struct(*columns).alias("_new"), _bucket(key, buckets).alias("_b"))
    asked = [r["_b"] for r in clean.select("_b").distinct().collect()]           # at most the number of buckets
    stored = _rows(spark, root, {b: versions[b] for b in asked if b in versions}).select(key, F.struct(*columns).alias("_old"))
    both = stored.join(clean.drop("_b"), key, "full_outer").withColumn("_b", _bucket(key, buckets))
    inserted = F.col("_old").isNull() & F.lit(mode != "update")
    updated = F.col("_old").isNotNull() & F.col("_new").isNotNull() & ~F.col("_old").eqNullSafe(F.col("_new")) & F.lit(mode != "ignore")
    marked = both.withColumn("_ins", inserted).withColumn("_upd", updated)
    per = marked.groupBy("_b").agg(F.count_if("_ins").alias("i"), F.count_if("_upd").alias("u")).where("i + u > 0").collect()
    if per:
        taken = F.when(F.col("_ins") | F.col("_upd"), F.col("_new")).otherwise(F.col("_old"))
        rows = marked.where(F.col("_b").isin([r["_b"] for r in per])).where("_old is not null or _ins").select(key, taken.alias("_row"), "_b")
        versions |= _write(rows.select(key, "_row.*", "_b"), root, known[-1] + 1)
    _commit(spark, root, known[-1] + 1, versions, batch, buckets)
    return {"buckets": len(per), "inserted": sum(r.i for r in per), "updated": sum(r.u for r in per), "conflicts": n_odd}
