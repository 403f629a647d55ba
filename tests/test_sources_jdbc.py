"""Split reads from a JDBC warehouse: what is asked of Spark's reader (no database here)."""

from types import SimpleNamespace

import pytest

from stockout import schemas
from stockout.sources.tables import TABLES, day_predicates, read_jdbc


def test_splits_reach_the_reader(spark):
    asked = {}

    def jdbc(url, table, **how):
        asked[table] = how
        return spark.createDataFrame([], schemas.SOURCE_SCHEMAS[table])

    fake = SimpleNamespace(read=SimpleNamespace(jdbc=jdbc))
    bounds = {"column": "prd_cd", "lowerBound": 1, "upperBound": 9, "numPartitions": 4}
    days = day_predicates("ord_dt", ["20160809", "20160808"])
    read_jdbc(fake, "jdbc:x", {t: t for t in TABLES}, {"user": "u"}, {"order_fact": days, "product": bounds})
    assert asked["order_fact"] == {"properties": {"user": "u"}, "predicates": days}
    assert asked["product"] == {"properties": {"user": "u"}, **bounds}
    assert asked["item"] == {"properties": {"user": "u"}}
    with pytest.raises(ValueError):
        read_jdbc(fake, "jdbc:x", {t: t for t in TABLES}, splits={"orders": days})


def test_day_predicates_cover_every_row_once(spark):
    rows = spark.createDataFrame([(d,) for d in ("20160101", "20160808", "20160809", "20170101", None)], "ord_dt string")
    parts = [rows.where(p).count() for p in day_predicates("ord_dt", ["20160808", "20160809"])]
    assert parts == [2, 1, 2]
