"""Result tables as day-partitioned parquet under a shared folder.

A rerun must replace exactly the days it was asked for: days with rows are overwritten as
partitions (``partitionOverwriteMode=dynamic``), asked-for days that have no rows any more lose
their partition, other days are left alone. Both channels of a day are in the same DataFrame, so
one write covers the day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockout import schemas
from stockout.session import ensure_checkpoint_dir
from stockout.stage import write_stage


ALL_DAYS = "all"


class KeyViolation(ValueError):
    pass


def output_root(spark: SparkSession) -> str:
    """Default home of the result tables: ``stockout.output.dir`` if set, else a folder
    beside the shared checkpoint folder (a scratch folder only on a local master)."""
    root = spark.conf.get("stockout.output.dir", None)
    return root or ensure_checkpoint_dir(spark).rstrip("/") + "/tables"


def check_keys(df: DataFrame, key: tuple[str, ...], required: tuple[str, ...] = ()) -> None:
    """Pre-write check: no null in the key or ``required`` columns, no duplicate key (one
    small job; the result is two counts, nothing else is collected)."""
    nulls = F.lit(False)
    for k in tuple(key) + tuple(required):
        nulls = nulls | F.col(k).isNull()
    stats = (df.groupBy(*key).agg(F.count("*").alias("_n"), F.max(nulls).alias("_null"))
             .agg(F.count(F.when(F.col("_n") > 1, 1)).alias("dups"),
                  F.count(F.when(F.col("_null"), 1)).alias("nulls"))
             .first())
    if stats["dups"] or stats["nulls"]:
        raise KeyViolation(f"key {key}: {stats['dups']} duplicated, {stats['nulls']} with nulls")


def _delete_partition(spark: SparkSession, path: str, day: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/broad_dt={day}")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _write_days(df: DataFrame, path: str, days: tuple[str, ...] | str | None) -> str:
    """``days``: those that the rows were computed for (rows of other days are an error), ALL_DAYS to
    replace the whole table, or None for the days that have rows."""
    if days == ALL_DAYS:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("broad_dt").parquet(path)
        return path
    emptied: set[str] = set()
    if days is not None:
        # Few strings: the days of a run.
        present = {r["broad_dt"] for r in df.select("broad_dt").distinct().collect()}
        if present - set(days):
            raise ValueError(f"rows of days that were not asked for: {sorted(present - set(days))}")
        emptied = set(days) - present
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("broad_dt").parquet(path)
    for day in sorted(emptied):
        _delete_partition(df.sparkSession, path, day)
    return path


def snapshot_rows(snapshot: DataFrame) -> DataFrame:
    """The snapshot's columns and types, checked."""
    out = snapshot.select([F.col(f.name).cast(f.dataType) for f in schemas.SNAPSHOT_SCHEMA.fields])
    check_keys(out, schemas.SNAPSHOT_KEY, required=("value",))
    return out


def report_rows(report: DataFrame) -> DataFrame:
    """The report (English keys), checked."""
    check_keys(report, schemas.REPORT_KEY + ("broad_dt",))
    return report


def write_snapshot(snapshot: DataFrame, path: str | None = None, table: str = "soldout_snapshot",
                   days: tuple[str, ...] | str | None = None) -> str:
    """Write ``(pgm_id, soldout_seq, attr_prd_cd, value, broad_dt)`` by day (see ``_write_days``)."""
    path = path or f"{output_root(snapshot.sparkSession)}/{table}"
    return _write_days(snapshot_rows(snapshot), path, days)


def write_report(report: DataFrame, path: str | None = None, table: str = "soldout_report",
                 days: tuple[str, ...] | str | None = None) -> str:
    """Write the report (English keys; display names are a presentation choice) by day."""
    path = path or f"{output_root(report.sparkSession)}/{table}"
    return _write_days(report_rows(report), path, days)


def load_days(report: DataFrame, snapshot: DataFrame, report_path: str | None, snapshot_path: str | None,
              days: tuple[str, ...] | str) -> tuple[str, str]:
    """Load both tables: each is computed once, to a stage, and both are checked before either
    is touched."""
    root = output_root(report.sparkSession)
    report, snapshot = write_stage(report, "report"), write_stage(snapshot, "snapshot")
    report, snapshot = report_rows(report), snapshot_rows(snapshot)
    return (_write_days(report, report_path or f"{root}/soldout_report", days),
            _write_days(snapshot, snapshot_path or f"{root}/soldout_snapshot", days))


def replace_table(report: DataFrame, name: str) -> str:
    """Replace a whole catalog table (the reference's trial table)."""
    report.write.mode("overwrite").saveAsTable(name)
    return name


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a catalog table written by ``replace_table``."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def load_snapshot(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select([F.col(f.name).cast(f.dataType) for f in schemas.SNAPSHOT_SCHEMA.fields])


def load_report(spark: SparkSession, path: str) -> DataFrame:
    # The partition column's type is guessed from its folder names.
    return spark.read.parquet(path).withColumn("broad_dt", F.col("broad_dt").cast("string"))
