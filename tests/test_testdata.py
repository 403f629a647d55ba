"""The nine tables derived from the test tables: equal to the mapping's plain SQL, and what a task reads for them."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockout.sources import testdata
from stockout.sources.tables import TABLES, read_parquet_root, write_parquet_root

PART = ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Part 3 twice, part 4 unsold, a part without type, brand or name; lines without part, day or supplier."""
    root = str(tmp_path_factory.mktemp("tables"))
    parts = [(1, "red cup", "Brand#11", "SMALL", 3, 9.5), (2, "blue cup", "Brand#11", "SMALL", 7, 8.25),
             (3, "green pan", "Brand#12", "LARGE", 5, 4.0), (3, "green pan", "Brand#12", "LARGE", 5, 4.0),
             (4, "a pot", "Brand#13", "PROMO", 1, 1.0), (5, None, None, None, None, None)]
    lines = [(i, [1, 2, 3, 5, None][i % 5], [0, 1, 2, -1, -2, None][i % 6], 1 + i % 7, float(i % 9), 10.0 * i, 0.05,
              0.02 * (i % 2), "NRA"[i % 3], "O", None if i % 41 == 0 else dt.datetime(1995 + i % 3, 1 + i % 12, 1 + i % 28))
             for i in range(400)]
    spark.createDataFrame(parts, PART).write.parquet(f"{root}/part.parquet")
    spark.createDataFrame(lines, LINE).write.parquet(f"{root}/lineitem.parquet")
    spark.createDataFrame([(i, f"R{i}") for i in range(5)], "r_regionkey int, r_name string").write.parquet(f"{root}/region.parquet")
    return root


def test_dimension_tables_equal_the_plain_mapping(spark, tables):
    src = testdata.derive_testdata(spark, tables)
    lines = (spark.read.parquet(f"{tables}/lineitem.parquet")
             .join(spark.read.parquet(f"{tables}/part.parquet"), F.col("l_partkey") == F.col("p_partkey")))
    lines.withColumns({"y": F.year("l_shipdate"), "bn": F.expr("CAST(substring(p_brand, 7) AS BIGINT)"),
                       "ti": F.expr(testdata._TYPE_INDEX)}).createOrReplaceTempView("plain_base")
    plain = {
        "broadcast": "SELECT DISTINCT y FROM plain_base",
        "broadcast_product": "SELECT DISTINCT y, bn FROM plain_base",
        "product": "SELECT bn, min(y) || '0101', CAST(min(p_retailprice) AS DECIMAL(18,2)) FROM plain_base GROUP BY bn",
        "attr_product": "SELECT bn, bn * 10 + ti, min(split_part(p_name, ' ', 1)) FROM plain_base GROUP BY bn, ti, p_type",
        "target_minutes": "SELECT y, bn, 60 * count(*), 90 * count(*) FROM plain_base WHERE y > 1995 GROUP BY y, bn, l_suppkey % 3",
        "supply_plan": "SELECT DISTINCT y * 100 + bn, y, bn FROM plain_base",
        "supply_appointment": "SELECT y * 100 + bn, bn, bn * 10 + ti, CASE WHEN ti = 6 THEN 0 ELSE 2 * sum(p_size) END FROM "
                              "(SELECT DISTINCT y, bn, ti, p_partkey, p_size FROM plain_base) GROUP BY y, bn, ti",
    }
    columns = {"broadcast": ["pgm_id"], "broadcast_product": ["pgm_id", "prd_cd"],
               "product": ["prd_cd", "fst_broad_dt", "fst_prd_sale_prc"], "attr_product": ["prd_cd", "attr_prd_cd", "attr_prd_1_val"],
               "target_minutes": ["pgm_id", "prd_cd", "weiht_mi", "expos_mi"], "supply_plan": ["suply_plan_mng_no", "pgm_id", "prd_cd"],
               "supply_appointment": ["suply_plan_mng_no", "prd_cd", "attr_prd_rep_cd", "suply_apnt_qty"]}
    for name, sql in plain.items():
        got = [tuple(r) for r in getattr(src, name).select(*columns[name]).collect()]
        assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in spark.sql(sql).collect()), name
    assert src.order_fact.count() == spark.table("plain_base").count()


def test_kept_rows_do_not_grow_with_the_lines(spark, tables, tmp_path):
    for name in ("part", "region"):
        spark.read.parquet(f"{tables}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    lines = spark.read.parquet(f"{tables}/lineitem.parquet")
    lines.crossJoin(spark.range(20).select(F.col("id").alias("_k"))).drop("_k").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert testdata._base(spark, str(tmp_path)).count() == testdata._base(spark, tables).count() < lines.count() / 10


def test_written_tables_are_the_derived_ones_and_the_setting_comes_back(spark, tables, tmp_path):
    conf, src = "spark.sql.maxConcurrentOutputFileWriters", testdata.derive_testdata(spark, tables)
    before = spark.conf.get(conf)
    back = read_parquet_root(spark, write_parquet_root(src, str(tmp_path / "written")))
    assert spark.conf.get(conf) == before
    for name in TABLES:
        want, got = getattr(src, name), getattr(back, name).select(*getattr(src, name).columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
