-- The nine source tables over the pre-registered test tables (FIXTURES.md §3).
base AS (
    SELECT *,
           year(l_shipdate) AS y,
           CAST(substring(p_brand, 7) AS BIGINT) AS bn,
           CASE p_type WHEN 'SMALL' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LARGE' THEN 3
                       WHEN 'ECONOMY' THEN 4 WHEN 'PROMO' THEN 5 ELSE 6 END AS ti,
           CAST(floor((dayofyear(l_shipdate) - 1) / 7) AS INT) AS w,
           CASE WHEN l_returnflag = 'N' THEN 1300 - 22 * CAST(floor((dayofyear(l_shipdate) - 1) / 7) AS INT)
                ELSE 1300 + CAST(floor((dayofyear(l_shipdate) - 1) / 7) AS INT) END AS m
    FROM lineitem JOIN part ON l_partkey = p_partkey
),
broadcast AS (
    SELECT DISTINCT CAST(y AS BIGINT) AS pgm_id,
           CASE WHEN y % 2 = 0 THEN 'C' ELSE 'H' END AS chanl_cd,
           concat(CAST(y AS VARCHAR), '0101') AS broad_dt,
           CAST(concat(CAST(y AS VARCHAR), '-01-01 21:40:00') AS TIMESTAMP) AS broad_str_dtm,
           concat('Program ', CAST(y AS VARCHAR)) AS pgm_nm
    FROM base
),
broadcast_product AS (
    SELECT DISTINCT CAST(y AS BIGINT) AS pgm_id, bn AS prd_cd,
           CASE WHEN y % 2 = 0 THEN 'C' ELSE 'H' END AS chanl_cd
    FROM base
),
product AS (
    SELECT bn AS prd_cd, concat('Brand#', CAST(bn AS VARCHAR)) AS prd_nm, bn % 5 AS item_cd,
           concat('MD', CAST(bn % 7 AS VARCHAR)) AS md_id,
           concat(CAST(min(y) AS VARCHAR), '0101') AS fst_broad_dt,
           CAST(min(p_retailprice) AS DECIMAL(18,2)) AS fst_prd_sale_prc
    FROM base GROUP BY bn
),
item AS (
    SELECT CAST(r_regionkey AS BIGINT) AS item_cd, r_name AS item_nm FROM region
),
attr_product AS (
    SELECT bn AS prd_cd, bn * 10 + ti AS attr_prd_cd, bn * 10 + ti AS attr_prd_rep_cd,
           min(split_part(p_name, ' ', 1)) AS attr_prd_1_val,
           CASE ti WHEN 1 THEN 'S' WHEN 2 THEN 'M(95)' WHEN 3 THEN 'L' WHEN 4 THEN 'SS'
                   WHEN 5 THEN '100' ELSE 'FREE' END AS attr_prd_2_val,
           concat_ws(',', min(split_part(p_name, ' ', 1)), p_type,
                     concat('P', CAST(min(p_size) AS VARCHAR)), concat('T', CAST(max(p_size) AS VARCHAR)),
                     CASE WHEN ti = 1 THEN 'X' END) AS attr_prd_whl_val
    FROM base GROUP BY bn, ti, p_type
),
order_fact AS (
    SELECT CAST(y AS BIGINT) AS pgm_id, bn AS prd_cd, bn * 10 + ti AS attr_prd_cd,
           concat(CAST(y AS VARCHAR), CASE WHEN l_linenumber = 7 THEN '0103' ELSE '0101' END) AS ord_dt,
           concat(lpad(CAST(CAST(floor(m / 60) AS INT) AS VARCHAR), 2, '0'),
                  lpad(CAST(m % 60 AS VARCHAR), 2, '0')) AS ord_time,
           CAST(l_quantity AS BIGINT) AS tot_ord_qty,
           CAST(l_quantity AS BIGINT) - CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS net_ord_qty,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS tot_ord_amt,
           CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_linenumber AS DECIMAL(18,2)) AS net_ord_amt,
           CAST(l_linenumber AS DECIMAL(18,2)) AS sup_shr_tot_ord_dc_amt,
           CAST(l_linenumber AS DECIMAL(18,2)) AS sup_shr_net_ord_dc_amt,
           CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(1 AS DECIMAL(18,2)) END AS cmm_cpn_dc_amt,
           CAST(0 AS DECIMAL(18,2)) AS tot_ord_naccm_sale_amt,
           CAST(0 AS DECIMAL(18,2)) AS net_ord_naccm_sale_amt,
           CAST(l_discount AS DECIMAL(4,2)) AS naccm_sale_subtr_apply_rt,
           CAST(1 - CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(4,2)) AS chg_rt,
           CASE WHEN (y % 2 = 0) = (l_linenumber <> 6) THEN 'C' ELSE 'H' END AS broad_rlrslt_gbn_cd,
           CASE WHEN l_returnflag = 'N' THEN 'P1' ELSE 'O1' END AS broad_ord_time_dtl_cd,
           CASE WHEN l_tax = 0 THEN 0 ELSE 1 END AS tot_ord_cust_no
    FROM base
),
target_minutes AS (
    SELECT CAST(y AS BIGINT) AS pgm_id, bn AS prd_cd, 60 * count(*) AS weiht_mi, 90 * count(*) AS expos_mi
    FROM base WHERE y > 1995 GROUP BY y, bn, l_suppkey % 3
),
supply_plan AS (
    SELECT DISTINCT CAST(y * 100 + bn AS BIGINT) AS suply_plan_mng_no, CAST(y AS BIGINT) AS pgm_id,
           bn AS prd_cd, CAST(100 AS BIGINT) AS suply_psbl_qty, CAST(100 AS BIGINT) AS pgm_tgt_qty,
           CAST(bn % 7 AS VARCHAR) AS broad_bef_mng_prg_st_cd
    FROM base
),
supply_appointment AS (
    SELECT CAST(y * 100 + bn AS BIGINT) AS suply_plan_mng_no, bn AS prd_cd, bn * 10 + ti AS attr_prd_rep_cd,
           CASE WHEN ti = 6 THEN CAST(0 AS BIGINT) ELSE CAST(2 * sum(p_size) AS BIGINT) END AS suply_apnt_qty
    FROM (SELECT DISTINCT y, bn, ti, p_partkey, p_size FROM base) d
    GROUP BY y, bn, ti
)
