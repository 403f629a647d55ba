"""Write-once intermediate tables.

A stage several consumers read is written as parquet under the shared checkpoint folder
(``spark.checkpoint.dir``) and read back. Unlike an eager ``Dataset.checkpoint``, which runs
the plan once to count and again to save, the write runs it once; the read-back plan starts
from files (lineage cut, survives executor loss) and carries file sizes, so the planner can
decide broadcasts from measured sizes.

``bucket_by`` writes the stage as a bucketed table (one file per bucket, registered in the
session catalog over that folder): reading it back gives a hash partitioning on those
columns, so joins, aggregates and windows keyed by them need no further shuffle.

What a stage's plan shuffled is freed as soon as the stage is written: nothing reads it again, and
Spark itself would hold it until the driver happens to collect garbage.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from stockout.session import ensure_checkpoint_dir


def bucket_count(spark) -> int:
    """Buckets of a bucketed stage: ``stockout.stage.buckets`` if set, else one per core of
    the cluster (``defaultParallelism``), at most ``spark.sql.shuffle.partitions``. Bucketed
    scans are not coalesced by AQE, so the count must fit the cluster, not a default of 200."""
    configured = spark.conf.get("stockout.stage.buckets", None)
    if configured:
        return max(1, int(configured))
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(shuffle, spark.sparkContext.defaultParallelism))


def new_run_tag() -> str:
    return uuid.uuid4().hex


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark) -> Iterator[None]:
    """Statements begun inside free their shuffle files when they end."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def write_stage(df: DataFrame, name: str, bucket_by: tuple[str, ...] | list[str] | None = None,
                run_tag: str | None = None, resume: bool = False, compression: str | None = None) -> DataFrame:
    """Write ``df`` to ``<checkpoint dir>/stages/<run_tag>/<name>-<id>`` and read it back. A
    run passes one tag for all its stages, so a run's intermediates sit in one folder (left
    to the shared folder's retention policy).

    ``resume``: the stage's place follows from tag and name alone, and a stage that was written whole
    before (its ``_SUCCESS`` file is there) is read and not computed again. The tag must then say
    everything that the stage depends on. ``compression``: the codec of a stage that is not bucketed, if
    not the session's."""
    spark = df.sparkSession
    tag = uuid.uuid4().hex
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stages/{run_tag or tag}"
    path = f"{root}/{name}" if resume else f"{root}/{name}-{tag}"
    done = resume and _exists(spark, f"{path}/{'_buckets' if bucket_by else '_SUCCESS'}")
    if not bucket_by:
        if not done:
            with _shuffles_freed(spark):
                df.write.mode("overwrite").parquet(path, compression=compression)
        return spark.read.parquet(path)
    table = f"stockout_{name}_{run_tag or tag}_{'kept' if resume else tag[:8]}"
    buckets = bucket_count(spark)
    if not done:
        with _shuffles_freed(spark):
            (df.repartition(buckets, *bucket_by).write.mode("overwrite").option("path", path)
             .bucketBy(buckets, *bucket_by).saveAsTable(table))
        if resume:
            write_note(spark, f"{path}/_buckets", str(buckets))
    elif not spark.catalog.tableExists(table):  # written by an application that has ended
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        keys = ", ".join(f"`{c}`" for c in bucket_by)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({keys}) "
                  f"INTO {int(read_note(spark, f'{path}/_buckets'))} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def _file(spark, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _exists(spark, path: str) -> bool:
    fs, place = _file(spark, path)
    return fs.exists(place)


def write_note(spark, path: str, text: str) -> None:
    """A small text file, replaced if it is there."""
    fs, place = _file(spark, path)
    stream = fs.create(place, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_note(spark, path: str) -> str:
    """The text of a small file, empty if there is none."""
    fs, place = _file(spark, path)
    if not fs.exists(place):
        return ""
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def drop_run(spark, run_tag: str) -> None:
    """Remove a run's stages: its bucketed tables from the catalog, and its folder."""
    for table in spark.catalog.listTables():
        if f"_{run_tag}_" in table.name:
            spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/stages/{run_tag}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
