"""The two reads of the daily job as SQL text with named arguments.

``read_sql`` runs a statement over the bundle's tables as temporary views; days and channels are bound
as parameters (``:days``, ``:channels``: arrays of text, null for all), never put into the text.
Filters on them and on the order lines reach the scans as they do in the DataFrame form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockout.operators.scope import ALL, Scope
from stockout.sources.tables import TABLES, Sources

_RUN = """
run AS (
    SELECT pgm_id, chanl_cd AS run_chanl_cd, broad_dt, broad_str_dtm, pgm_nm,
           date_format(date_add(to_date(broad_dt, 'yyyyMMdd'), 1), 'yyyyMMdd') AS next_dt
    FROM {broadcast}
    WHERE (CAST(:days AS ARRAY<STRING>) IS NULL OR array_contains(CAST(:days AS ARRAY<STRING>), broad_dt))
      AND (CAST(:channels AS ARRAY<STRING>) IS NULL OR array_contains(CAST(:channels AS ARRAY<STRING>), chanl_cd))
)"""

#: Units on air per option and minute of the run's broadcasts.
MINUTE_ORDERS = f"""
WITH {_RUN},
offered AS (
    SELECT DISTINCT pgm_id, prd_cd FROM {{broadcast_product}} LEFT SEMI JOIN {{product}} USING (prd_cd)
)
SELECT r.pgm_id, max(f.prd_cd) AS prd_cd, r.run_chanl_cd AS chanl_cd, f.attr_prd_cd, f.ord_dt, f.ord_time,
       sum(f.tot_ord_qty) AS tot_ord_qty
FROM {{order_fact}} f
JOIN run r ON f.pgm_id = r.pgm_id AND f.ord_dt BETWEEN r.broad_dt AND r.next_dt
LEFT SEMI JOIN offered o ON o.pgm_id = f.pgm_id AND o.prd_cd = f.prd_cd
WHERE f.broad_ord_time_dtl_cd = :on_air AND f.tot_ord_cust_no > 0
  AND f.ord_dt BETWEEN coalesce(array_min(CAST(:days AS ARRAY<STRING>)), '') AND coalesce(:last_order_day, '99999999')
GROUP BY r.pgm_id, r.run_chanl_cd, f.attr_prd_cd, f.ord_dt, f.ord_time
"""

#: One row per broadcast and option of the run with its sales, supply and exposure.
REPORT_BASE = f"""
WITH {_RUN},
listing AS (SELECT DISTINCT pgm_id, prd_cd, chanl_cd FROM {{broadcast_product}}),
run_product AS (SELECT DISTINCT prd_cd FROM listing LEFT SEMI JOIN run USING (pgm_id)),
aired AS (
    SELECT l.pgm_id, l.prd_cd, l.chanl_cd,
           dense_rank() OVER (PARTITION BY l.prd_cd, l.chanl_cd ORDER BY b.broad_str_dtm) AS broad_seq
    FROM listing l LEFT SEMI JOIN run_product p ON p.prd_cd = l.prd_cd
    JOIN {{broadcast}} b ON b.pgm_id = l.pgm_id
),
pgm AS (
    SELECT r.*, a.prd_cd, a.chanl_cd, a.broad_seq
    FROM run r JOIN aired a USING (pgm_id) LEFT SEMI JOIN {{product}} p ON p.prd_cd = a.prd_cd
),
choice AS (
    SELECT p.prd_cd, p.md_id, p.prd_nm, i.item_nm, p.item_cd, o.attr_prd_cd, o.attr_prd_rep_cd, o.attr_prd_whl_val,
           substring(p.fst_broad_dt, 1, 4) AS fst_broad_yyyy, substring(p.fst_broad_dt, 5, 2) AS fst_broad_mm,
           p.fst_broad_dt, p.fst_prd_sale_prc, o.attr_prd_1_val, o.attr_prd_2_val AS attr_prd_2_val_org,
           CASE WHEN instr(o.attr_prd_2_val, '(') > 0 THEN nullif(substring_index(o.attr_prd_2_val, '(', 1), '')
                ELSE o.attr_prd_2_val END AS attr_prd_2_val
    FROM {{product}} p
    JOIN {{attr_product}} o ON o.prd_cd = p.prd_cd
    JOIN {{item}} i ON i.item_cd = p.item_cd
    LEFT SEMI JOIN pgm ON pgm.prd_cd = p.prd_cd
),
-- Fixed values: places of the named sizes; any other goes by its first number.
size_place AS (
    SELECT prd_cd, size,
           coalesce(element_at(map('SS', '10', 'S', '20', 'M', '30', 'L', '40', 'XL', '50', '2XL', '60', 'XXL', '60'), size),
                    concat('1', CASE WHEN length(digits) BETWEEN 1 AND 3 THEN lpad(digits, 4, '0') ELSE digits END)) AS place
    FROM (SELECT DISTINCT prd_cd, attr_prd_2_val AS size, coalesce(regexp_substr(attr_prd_2_val, '[0-9]+'), '') AS digits
          FROM choice WHERE attr_prd_2_val IS NOT NULL)
),
size_list AS (
    SELECT prd_cd, array_join(transform(array_sort(collect_list(struct(place, size))), x -> x.size), '_') AS size_str
    FROM size_place GROUP BY prd_cd
),
colours AS (SELECT prd_cd, count(DISTINCT attr_prd_1_val) AS color_cnt FROM choice GROUP BY prd_cd),
exposure AS (
    SELECT pgm_id, prd_cd, sum(weiht_mi) AS weiht, sum(expos_mi) AS expos FROM {{target_minutes}} GROUP BY pgm_id, prd_cd
),
promise AS (
    SELECT s.pgm_id, s.prd_cd, a.attr_prd_rep_cd, sum(a.suply_apnt_qty) AS units
    FROM {{supply_plan}} s JOIN {{supply_appointment}} a USING (suply_plan_mng_no, prd_cd)
    WHERE s.broad_bef_mng_prg_st_cd <> :plan_left_out
    GROUP BY s.pgm_id, s.prd_cd, a.attr_prd_rep_cd
),
line AS (
    SELECT pgm_id, prd_cd, attr_prd_cd, broad_rlrslt_gbn_cd, broad_ord_time_dtl_cd, concat(ord_dt, ord_time) AS minute, ord_dt,
           chg_rt, tot_ord_qty, naccm_sale_subtr_apply_rt,
           tot_ord_amt + sup_shr_tot_ord_dc_amt + cmm_cpn_dc_amt * CAST(tot_ord_qty AS DECIMAL(18, 0)) + tot_ord_naccm_sale_amt AS gross,
           net_ord_amt + sup_shr_net_ord_dc_amt + cmm_cpn_dc_amt * CAST(net_ord_qty AS DECIMAL(18, 0)) + net_ord_naccm_sale_amt AS net
    FROM {{order_fact}}
    WHERE broad_ord_time_dtl_cd IN (:on_air, :pre_order) AND tot_ord_cust_no > 0
      AND ord_dt BETWEEN coalesce(array_min(CAST(:days AS ARRAY<STRING>)), '') AND coalesce(:last_order_day, '99999999')
),
sold AS (
    SELECT l.pgm_id, l.prd_cd, l.attr_prd_cd, max(l.chg_rt) AS chg_rt, sum(l.gross) AS gross, sum(l.net) AS net,
           sum(round(l.gross * l.chg_rt * (1 - l.naccm_sale_subtr_apply_rt))) AS expected,
           sum(l.tot_ord_qty) FILTER (WHERE l.minute BETWEEN date_format(date_trunc('DAY', p.broad_str_dtm) + INTERVAL 3 HOURS, 'yyyyMMddHHmm')
                                      AND date_format(p.broad_str_dtm, 'yyyyMMddHHmm')) AS early,
           sum(l.tot_ord_qty) FILTER (WHERE l.broad_ord_time_dtl_cd = :on_air) AS on_air
    FROM line l
    JOIN pgm p ON p.pgm_id = l.pgm_id AND p.prd_cd = l.prd_cd AND p.chanl_cd = l.broad_rlrslt_gbn_cd
              AND l.ord_dt BETWEEN p.broad_dt AND p.next_dt
    GROUP BY l.pgm_id, l.prd_cd, l.attr_prd_cd
),
revenue AS (
    SELECT pgm_id, prd_cd, max(chg_rt) AS chg_rt, sum(gross) AS gross, sum(net) AS net, sum(expected) AS expected
    FROM sold GROUP BY pgm_id, prd_cd
),
quantity AS (
    SELECT pgm_id, attr_prd_cd, max(prd_cd) AS of_prd_cd, sum(early) AS early, sum(on_air) AS on_air FROM sold GROUP BY pgm_id, attr_prd_cd
),
first_day AS (
    SELECT prd_cd, min(broad_dt) AS myshop_fst_broad_dt
    FROM {{broadcast_product}} LEFT SEMI JOIN run_product USING (prd_cd) JOIN {{broadcast}} USING (pgm_id) GROUP BY prd_cd
)
SELECT c.item_nm, c.item_cd, c.prd_nm, c.prd_cd, z.size_str, k.color_cnt, c.fst_broad_yyyy, c.fst_broad_mm, c.attr_prd_cd,
       p.chanl_cd, p.broad_seq, c.attr_prd_1_val, c.attr_prd_2_val_org, c.attr_prd_2_val, c.attr_prd_whl_val,
       CAST(coalesce(s.units, 0) AS BIGINT) AS suply_apnt_qty, q.on_air AS tot_ord_qty,
       CASE WHEN q.of_prd_cd = c.prd_cd THEN q.early END AS pord_03_tot_ord_qty,
       CAST(ceil(v.gross / 1000) AS BIGINT) AS tot_ord_amt, CAST(ceil(v.net / 1000) AS BIGINT) AS net_ord_amt,
       CAST(v.chg_rt AS DOUBLE) AS chg_rt, p.pgm_id, p.pgm_nm, p.broad_dt, p.broad_str_dtm,
       CAST(CASE WHEN e.weiht > 0 THEN round(CAST(v.expected AS DOUBLE) / (e.weiht / 60)) ELSE 0 END AS BIGINT) AS expct_sal_amt_per_wmi,
       CAST(round(e.weiht / 60) AS BIGINT) AS weiht_mi, CAST(round(e.expos / 60) AS BIGINT) AS expos_mi,
       f.myshop_fst_broad_dt, c.md_id, c.fst_broad_dt, CAST(c.fst_prd_sale_prc AS DOUBLE) AS fst_prd_sale_prc
FROM choice c
JOIN pgm p ON p.prd_cd = c.prd_cd
LEFT JOIN colours k ON k.prd_cd = c.prd_cd
LEFT JOIN size_list z ON z.prd_cd = c.prd_cd
LEFT JOIN exposure e ON e.pgm_id = p.pgm_id AND e.prd_cd = c.prd_cd
LEFT JOIN promise s ON s.pgm_id = p.pgm_id AND s.prd_cd = c.prd_cd AND s.attr_prd_rep_cd = c.attr_prd_rep_cd
LEFT JOIN revenue v ON v.pgm_id = p.pgm_id AND v.prd_cd = c.prd_cd
LEFT JOIN quantity q ON q.pgm_id = p.pgm_id AND q.attr_prd_cd = c.attr_prd_cd
LEFT JOIN first_day f ON f.prd_cd = c.prd_cd
ORDER BY pgm_id, attr_prd_cd
"""

# Order-time codes on air and pre-order, and the state of plans that do not count.
CODES = {"on_air": "O1", "pre_order": "P1", "plan_left_out": "0"}


def read_sql(spark: SparkSession, src: Sources, statement: str, scope: Scope = ALL) -> DataFrame:
    """Run ``statement`` (one of this module, or another over the bundle's table names in braces) with
    the scope's days and channels bound to it."""
    if scope.numeric_day_window:
        raise ValueError("the statements count calendar days")
    bounds = scope.order_day_bounds()
    every = {**CODES, "days": list(scope.days) if scope.days is not None else None,
             "channels": list(scope.channels) if scope.channels is not None else None,
             "last_order_day": bounds[1] if bounds else None}
    used = {name: value for name, value in every.items() if f":{name}" in statement}
    tables = {t: getattr(src, t) for t in TABLES if f"{{{t}}}" in statement}
    return spark.sql(statement, args=used, **tables)
