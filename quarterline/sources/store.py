"""Stored tables that change: snapshots, partition updates and keyed inserts.

* A *snapshot table* is a folder of versions.  A load writes a new version and it counts once Spark's committer has
  put ``_SUCCESS`` there, which it does last; readers resolve the newest version that counts.  A load that dies half
  way leaves the table as it was.
* A *partitioned table* is updated by overwriting, dynamically, just the partitions that hold a changed key.
* A *keyed table* is laid out by buckets of its key; an insert looks at the buckets of its own keys only and appends
  what is new.

Paths belong on shared storage (``session.shared_dir``).  What reaches the driver are version numbers and partition
values, one per folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.operators.estimates import first_per_key

#: Partition values that one update may touch, as literals of a pruning filter; more are a full rewrite's business.
MOST_PARTITIONS = 10_000


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under ``path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()] if fs.exists(where) else []


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where)


# ---------------------------------------------------------------- snapshots
def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n.removeprefix("version=")) for n in _folders(spark, root) if n.startswith("version="))


def snapshot_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version={version:010d}"


def versions(spark: SparkSession, root: str) -> list[int]:
    """The versions that count, oldest first."""
    return [n for n in _numbers(spark, root) if _exists(spark, f"{snapshot_path(root, n)}/_SUCCESS")]


def publish(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> int:
    """Write ``df`` as the table's next version (a full reload, S18); readers see it once it is whole.

    ``df`` may read the table itself.  Of two loads at once the later to start writing fails: a version's folder is
    made once.
    """
    spark = df.sparkSession
    version = max(_numbers(spark, root), default=0) + 1
    writer = df.write.mode("errorifexists").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(snapshot_path(root, version))
    return version


def current(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of its newest version, or of the given one."""
    known = versions(spark, root)
    if not known or version is not None and version not in known:
        raise ValueError(f"{root} has no " + ("version" if version is None else f"version {version}"))
    return spark.read.parquet(snapshot_path(root, version or known[-1]))


def append_snapshot(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> int:
    """The table with the rows of ``df`` added, by column name, as its next version."""
    spark = df.sparkSession
    old = current(spark, root) if versions(spark, root) else None
    return publish(df if old is None else old.unionByName(df), root, partition_by)


# ---------------------------------------------------------------- partition updates
def _touched(changes: DataFrame, partition: str) -> list:
    values = [r[0] for r in changes.select(partition).distinct().limit(MOST_PARTITIONS + 1).collect()]
    if len(values) > MOST_PARTITIONS:
        raise ValueError(f"changes touch over {MOST_PARTITIONS} partitions")
    return values


def update_stored(path: str, changes: DataFrame, keys: Sequence[str], set_columns: Sequence[str], partition: str,
                  pick_order: Sequence[str] | None = None) -> int:
    """``UPDATE table SET cols = c.cols FROM changes c WHERE keys match`` on a table stored by ``partition``.

    Rows without a match keep their values.  Of several changes of a key the first by ``pick_order`` (default: the set
    columns) applies.  ``changes`` holds ``partition`` too; only partitions with a change are read and written, the
    files of the others stay.  Returns how many partitions were written.
    """
    spark, keys, set_columns = changes.sparkSession, list(keys), list(set_columns)
    picked = changes.where(F.col(partition).isNotNull()).select(*dict.fromkeys([partition, *keys, *set_columns, *(pick_order or [])]))
    # three jobs read the changes: they are worked out once, and kept on the executors' disks meanwhile
    picked = first_per_key(picked, [partition, *keys], list(pick_order or set_columns)).select(
        partition, *keys, *[F.col(c).alias(f"__new_{c}") for c in set_columns], F.lit(True).alias("__changed")).persist(StorageLevel.DISK_ONLY)
    try:
        touched = _touched(picked, partition)
        if not touched:
            return 0
        stored = spark.read.parquet(path)
        columns = stored.columns
        # partitions that hold none of the changed keys have nothing to write
        rows = stored.where(F.col(partition).isin(touched))
        hit = _touched(rows.join(picked, [partition, *keys], "left_semi"), partition)
        if not hit:
            return 0
        kinds = {f.name: f.dataType for f in stored.schema.fields}
        value = {c: F.when(F.col("__changed"), F.col(f"__new_{c}").cast(kinds[c])).otherwise(F.col(c)).alias(c) for c in set_columns}
        new = stored.where(F.col(partition).isin(hit)).join(picked, [partition, *keys], "left").select(*[value.get(c, F.col(c)) for c in columns])
        new.repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
        return len(hit)
    finally:
        picked.unpersist()


def clear_partitions(spark: SparkSession, path: str, partition: str, values: Sequence) -> None:
    """Remove whole partitions before they are rebuilt."""
    where = spark._jvm.org.apache.hadoop.fs.Path
    for v in values:
        folder = where(f"{path}/{partition}={v}")
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


# ---------------------------------------------------------------- keyed inserts
BUCKET = "__bucket"


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int"))


def create_keyed(df: DataFrame, path: str, key: str = "ticker", buckets: int = 64) -> None:
    """Store a dimension by buckets of its key; a NULL key is refused, as a primary key refuses it."""
    kept = _bucketed(df.where(F.col(key).isNotNull()), key, buckets)
    kept.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def insert_new(spark: SparkSession, path: str, seed: DataFrame, key: str = "ticker", buckets: int = 64, order: Sequence[str] = ()) -> None:
    """``INSERT ... ON CONFLICT (key) DO NOTHING`` into a stored dimension.

    Reads the key column of the seed's buckets, and appends the seed's new rows to them, columns missing in the seed
    as NULL.  Of several seed rows of a key the first by ``order`` (default: the other columns) counts.  ``buckets``
    is that of ``create_keyed``.
    """
    stored = spark.read.parquet(path)
    rows = _bucketed(seed.where(F.col(key).isNotNull()), key, buckets)
    touched = _touched(rows, BUCKET)
    if not touched:
        return
    known = stored.where(F.col(BUCKET).isin(touched)).select(BUCKET, key)
    new = rows.join(known, [BUCKET, key], "left_anti")
    new = first_per_key(new, [BUCKET, key], list(order) or [c for c in seed.columns if c != key])
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in new.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in stored.schema.fields]
    new.select(*typed).repartition(BUCKET).write.mode("append").partitionBy(BUCKET).parquet(path)


def keyed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)
