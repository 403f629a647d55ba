"""The nine source tables as one bundle of DataFrames.

Every operator takes a :class:`Sources`; where the tables come from (a parquet lake, a
JDBC warehouse, or the TPC-H adapter used by the tests) is decided once, here.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from stockout import schemas


@dataclass(frozen=True)
class Sources:
    broadcast: DataFrame
    broadcast_product: DataFrame
    product: DataFrame
    item: DataFrame
    attr_product: DataFrame
    order_fact: DataFrame
    target_minutes: DataFrame
    supply_plan: DataFrame
    supply_appointment: DataFrame


TABLES = tuple(f.name for f in fields(Sources))


def _conform(df: DataFrame, name: str) -> DataFrame:
    """Select the declared columns with the declared types (extra columns are pruned)."""
    schema = schemas.SOURCE_SCHEMAS[name]
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def read_parquet_root(spark: SparkSession, root: str) -> Sources:
    """Nine tables stored as ``{root}/{table}`` parquet folders (Hive-style partitions allowed,
    e.g. ``order_fact/ord_dt=20160808``: the day window then prunes partitions). The declared
    schema is given to the reader, so partition columns keep their declared (string) type."""
    return Sources(**{t: _conform(spark.read.schema(schemas.SOURCE_SCHEMAS[t]).parquet(f"{root}/{t}"), t)
                      for t in TABLES})


# Day partitioning of the written fact table; the others are small dimension tables.
PARTITION_COLUMNS = {"order_fact": ("ord_dt",)}

# Up to so many days a task keeps a file open for each; beyond, it sorts its rows by day first.
OPEN_FILES = 32
_OPEN_FILES_CONF = "spark.sql.maxConcurrentOutputFileWriters"


def write_parquet_root(src: Sources, root: str, parallelism: int = 4) -> str:
    """Write the nine tables as ``{root}/{table}``, the fact table partitioned by order day.
    The writes are independent jobs and are submitted side by side."""
    from concurrent.futures import ThreadPoolExecutor

    def write(t: str) -> None:
        writer = getattr(src, t).write.mode("overwrite")
        if t in PARTITION_COLUMNS:
            writer = writer.partitionBy(*PARTITION_COLUMNS[t])
        writer.parquet(f"{root}/{t}")

    spark = src.order_fact.sparkSession
    before = spark.conf.get(_OPEN_FILES_CONF, None)
    spark.conf.set(_OPEN_FILES_CONF, str(OPEN_FILES))
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            for fut in [pool.submit(write, t) for t in TABLES]:
                fut.result()
    finally:
        if before is None:
            spark.conf.unset(_OPEN_FILES_CONF)
        else:
            spark.conf.set(_OPEN_FILES_CONF, before)
    return root


def read_jdbc(spark: SparkSession, url: str, dbtables: dict[str, str],
              properties: dict[str, str] | None = None,
              splits: dict[str, dict | list[str]] | None = None) -> Sources:
    """Nine tables from a JDBC warehouse; ``dbtables`` maps our table name to the remote
    one. Filters and projections on these DataFrames are pushed into the remote query.

    ``splits`` says by our table name how a table is read by several tasks: ``column``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` of a numeric or date column, or a list of
    predicates, one per task, which must cover every row once (see :func:`day_predicates`).
    A table without an entry is read by one task."""
    props, splits = dict(properties or {}), dict(splits or {})
    if unknown := set(splits) - set(TABLES):
        raise ValueError(f"no such tables: {sorted(unknown)}")

    def read(t: str) -> DataFrame:
        split = splits.get(t, {})
        how = split if isinstance(split, dict) else {"predicates": split}
        return _conform(spark.read.jdbc(url, dbtables[t], properties=props, **how), t)

    return Sources(**{t: read(t) for t in TABLES})


def day_predicates(column: str, days: list[str]) -> list[str]:
    """Predicates that cut a table at ``days`` (yyyymmdd text): before the first, from each to the
    next, from the last on, and rows without a day; together they cover every row once."""
    edges = sorted(set(days))
    if not edges or not all(d.isdigit() and len(d) == 8 for d in edges):
        raise ValueError("days are given as yyyymmdd")
    inner = [f"{column} >= '{a}' AND {column} < '{z}'" for a, z in zip(edges, edges[1:], strict=False)]
    return [f"{column} < '{edges[0]}' OR {column} IS NULL", *inner, f"{column} >= '{edges[-1]}'"]
