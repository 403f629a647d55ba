"""DuckDB statements that compute, from the pre-registered test tables, what each registered
Spark query computes. They state the source tables (``fixture.sql``) and the rules of the
report and of the sold-out minute (``blocks.sql``) in plain SQL, independently of the Spark code."""

from __future__ import annotations

from pathlib import Path

_HERE = Path(__file__).resolve().parent
_PRELUDE = None


def _prelude() -> str:
    global _PRELUDE
    if _PRELUDE is None:
        fixture = (_HERE / "fixture.sql").read_text()
        blocks = (_HERE / "blocks.sql").read_text()
        _PRELUDE = "WITH " + fixture.strip() + ",\n" + blocks.strip() + "\n"
    return _PRELUDE


_RANK_POOL = ("array_to_string(list_sort(list_distinct([CAST(floor(({n} // 5 + 1) + i * (({n} - 1) - ({n} // 5 + 1)) / 4) AS INT)"
              " FOR i IN range(5)])), ',')").format(n="n_train_options")

_PRESENT = """
SELECT r.item_nm AS "아이템명", r.item_cd AS "아이템코드", r.size_str AS "사이즈_체계",
       r.color_cnt AS "컬러수", r.prd_nm AS "상품명", r.prd_cd AS "상품코드",
       TRY_CAST(r.fst_broad_yyyy AS INT) AS "런칭년도", TRY_CAST(r.fst_broad_mm AS INT) AS "런칭월",
       r.attr_prd_cd AS "속성코드", r.chanl_cd AS "방송채널코드", r.broad_seq AS "방송회차", r.pgm_id AS "방송코드",
       r.attr_prd_1_val AS "컬러", r.attr_prd_2_val_org AS "사이즈", r.attr_prd_2_val AS "사이즈_변환",
       CASE WHEN len(string_split(r.attr_prd_whl_val, ',')) >= 3 THEN string_split(r.attr_prd_whl_val, ',')[3] END AS "사이즈2",
       CASE WHEN len(string_split(r.attr_prd_whl_val, ',')) >= 4
            THEN nullif(array_to_string(string_split(r.attr_prd_whl_val, ',')[4:], ' '), '') END AS "사이즈3",
       t.sold_out_flag AS "품절여부", t.sold_out_dtm AS "일시품절",
       r.suply_apnt_qty AS "공급약속수량", coalesce(r.pord_03_tot_ord_qty, 0) AS "미리주문",
       f.value AS "첫일시품절시_수량", coalesce(r.tot_ord_qty, 0) AS "실제_총주문_수량",
       r.pgm_nm AS "프로그램명", r.broad_dt AS "방송일자", r.broad_str_dtm AS "방송일자시간",
       strftime(r.broad_str_dtm, '%m/%d') || ' (' ||
         CASE dayofweek(r.broad_str_dtm) WHEN 0 THEN '일' WHEN 1 THEN '월' WHEN 2 THEN '화' WHEN 3 THEN '수'
              WHEN 4 THEN '목' WHEN 5 THEN '금' ELSE '토' END || ') ' || strftime(r.broad_str_dtm, '%H') || '시' AS "방송시간",
       r.tot_ord_amt AS "총주문_천원", r.net_ord_amt AS "순주문_천원", r.chg_rt AS "전환율", r.expos_mi AS "노출분",
       r.weiht_mi AS "가중분", r.expct_sal_amt_per_wmi AS "가중분취", r.attr_prd_whl_val AS "상품속성값",
       TRY_CAST(r.myshop_fst_broad_dt AS BIGINT) AS "데이터런칭일자", r.md_id AS "MDID",
       r.fst_broad_dt AS "라이브런칭일자", r.fst_prd_sale_prc AS "최초판매가"
FROM report_base r
JOIN gate g ON g.pgm_id = r.pgm_id AND g.prd_cd = r.prd_cd AND g.passes
LEFT JOIN soldout_time t ON t.pgm_id = r.pgm_id AND t.prd_cd = r.prd_cd AND t.attr_prd_cd = r.attr_prd_cd
LEFT JOIN (SELECT pgm_id, prd_cd, attr_prd_cd, value FROM soldout_snapshot WHERE soldout_seq = 1) f
  ON f.pgm_id = r.pgm_id AND f.prd_cd = r.prd_cd AND f.attr_prd_cd = r.attr_prd_cd
"""

def _quotient(a: str, b: str) -> str:
    """a / b rounded half away from zero; 0 where b is 0."""
    return f"(CASE WHEN ({b}) = 0 THEN 0 ELSE sign({a}) * ((2 * abs({a}) + ({b})) // (2 * ({b}))) END)"


def _rank_one() -> str:
    """The blocks of ``rank_one.sql``: two rounds of biases, three of factors, one block each."""
    steps = []
    by = {"option": "attr_prd_cd", "minute": "ord_ts"}
    last: dict[tuple[str, str], str] = {}

    def block(kind: str, side: str, body: str) -> None:
        last[kind, side] = f"{kind}_{side}_{len(steps)}"
        steps.append(f"{last[kind, side]} AS MATERIALIZED ({body})")

    for _ in range(2):
        for side, other in (("option", "minute"), ("minute", "option")):
            rest = "s.d"
            join = ""
            if ("bias", other) in last:
                rest, join = "s.d - o.v", f"JOIN {last['bias', other]} o USING (pgm_id, prd_cd, {by[other]})"
            block("bias", side, f"SELECT pgm_id, prd_cd, {by[side]}, {_quotient(f'sum({rest})', 'count(*) + 1')} AS v "
                                f"FROM seen s {join} GROUP BY pgm_id, prd_cd, {by[side]}")
    steps.append(f"rest AS MATERIALIZED (SELECT s.pgm_id, s.prd_cd, s.attr_prd_cd, s.ord_ts, s.d - a.v - b.v AS d FROM seen s "
                 f"JOIN {last['bias', 'option']} a USING (pgm_id, prd_cd, attr_prd_cd) "
                 f"JOIN {last['bias', 'minute']} b USING (pgm_id, prd_cd, ord_ts))")
    last["factor", "minute"] = last["bias", "minute"]
    for _ in range(3):
        for side, other in (("option", "minute"), ("minute", "option")):
            block("factor", side,
                  f"SELECT pgm_id, prd_cd, {by[side]}, {_quotient('(sum(s.d * o.v) * 1000000)', 'sum(o.v * o.v) + count(*) * 100000000000')} AS v "
                  f"FROM rest s JOIN {last['factor', other]} o USING (pgm_id, prd_cd, {by[other]}) GROUP BY pgm_id, prd_cd, {by[side]}")
    names = {f"last_{side}_{kind}": last[kind, side] for kind, side in last}
    return (_HERE / "rank_one.sql").read_text().format(
        mean=_quotient("sum(y)", "count(*)"), steps=",\n".join(steps),
        product=_quotient("(coalesce(f.v, 0) * coalesce(g.v, 0))", "CAST(1000000 AS HUGEINT)"), **names)


_FINAL = {
    "minute_orders": "SELECT pgm_id, prd_cd, chanl_cd, attr_prd_cd, ord_dt, ord_time, tot_ord_qty FROM minute_orders",
    "low_order_filter": """
        SELECT pgm_id, prd_cd, chanl_cd, attr_prd_cd, ord_dt, ord_time, tot_ord_qty FROM minute_orders
        WHERE pgm_id IN (SELECT pgm_id FROM minute_orders GROUP BY pgm_id HAVING sum(tot_ord_qty) >= 5)""",
    "broadcast_sequence": "SELECT pgm_id, prd_cd, chanl_cd, broad_str_dtm, broad_dt, pgm_nm, broad_seq, run_chanl_cd FROM airing",
    "product_attributes": """
        SELECT prd_cd, md_id, prd_nm, item_nm, item_cd, attr_prd_cd, fst_broad_yyyy, fst_broad_mm, fst_broad_dt,
               CAST(fst_prd_sale_prc AS DOUBLE) AS fst_prd_sale_prc, attr_prd_rep_cd, attr_prd_whl_val,
               attr_prd_1_val, attr_prd_2_val, attr_prd_2_val_org
        FROM option_info""",
    "product_attr_info": "SELECT prd_cd, color_cnt, size_str FROM product_facts",
    "exposure_minutes": """
        SELECT m.pgm_id, m.prd_cd, CAST(m.weiht_mi AS BIGINT) AS weiht_mi, CAST(m.expos_mi AS BIGINT) AS expos_mi,
               CAST(round(m.weiht_mi / 60) AS BIGINT) AS weiht_minutes, CAST(round(m.expos_mi / 60) AS BIGINT) AS expos_minutes
        FROM exposure m
        WHERE EXISTS (SELECT 1 FROM airing p WHERE p.pgm_id = m.pgm_id AND p.prd_cd = m.prd_cd)""",
    "supply_by_attr": "SELECT pgm_id, prd_cd, attr_prd_rep_cd, suply_apnt_qty FROM promised",
    "order_base": """
        SELECT pgm_id, prd_cd, attr_prd_cd, tot_ord_qty, CAST(net_ord_amt AS DOUBLE) AS net_ord_amt,
               CAST(sup_shr_net_ord_dc_amt AS DOUBLE) AS sup_shr_net_ord_dc_amt, net_ord_qty,
               CAST(net_ord_naccm_sale_amt AS DOUBLE) AS net_ord_naccm_sale_amt, CAST(tot_ord_amt AS DOUBLE) AS tot_ord_amt,
               CAST(sup_shr_tot_ord_dc_amt AS DOUBLE) AS sup_shr_tot_ord_dc_amt, CAST(cmm_cpn_dc_amt AS DOUBLE) AS cmm_cpn_dc_amt,
               CAST(naccm_sale_subtr_apply_rt AS DOUBLE) AS naccm_sale_subtr_apply_rt,
               CAST(tot_ord_naccm_sale_amt AS DOUBLE) AS tot_ord_naccm_sale_amt, CAST(chg_rt AS DOUBLE) AS chg_rt,
               broad_rlrslt_gbn_cd, ord_dt, ord_time, broad_ord_time_dtl_cd
        FROM line""",
    "order_revenue": """
        SELECT pgm_id, prd_cd, CAST(chg_rt AS DOUBLE) AS chg_rt, CAST(tot_ord_amt AS DOUBLE) AS tot_ord_amt,
               CAST(net_ord_amt AS DOUBLE) AS net_ord_amt, CAST(expct_sal_amt AS DOUBLE) AS expct_sal_amt
        FROM revenue""",
    "preorder_since_3am": """
        SELECT pgm_id, attr_prd_cd, prd_cd, CAST(early AS BIGINT) AS pord_03_tot_ord_qty FROM quantity""",
    "onair_qty": "SELECT pgm_id, attr_prd_cd, CAST(onair AS BIGINT) AS tot_ord_qty FROM quantity WHERE onair_lines > 0",
    "first_broadcast": """
        SELECT prd_cd, myshop_fst_broad_dt FROM first_airing SEMI JOIN option_info o USING (prd_cd)""",
    "report_base": """
        SELECT item_nm, item_cd, prd_nm, prd_cd, size_str, color_cnt, fst_broad_yyyy, fst_broad_mm, attr_prd_cd,
               chanl_cd, broad_seq, attr_prd_1_val, attr_prd_2_val_org, attr_prd_2_val, attr_prd_whl_val,
               suply_apnt_qty, tot_ord_qty, pord_03_tot_ord_qty, tot_ord_amt, net_ord_amt, chg_rt, pgm_id, pgm_nm,
               broad_dt, broad_str_dtm, expct_sal_amt_per_wmi, weiht_mi, expos_mi, myshop_fst_broad_dt, md_id,
               fst_broad_dt, fst_prd_sale_prc
        FROM report_base ORDER BY pgm_id, attr_prd_cd""",
    "order_grid": "SELECT pgm_id, prd_cd, attr_prd_cd, ord_ts, qty, supply, is_live, broad_dt FROM order_grid",
    "soldout_censored_grid": """
        SELECT pgm_id, prd_cd, attr_prd_cd, ord_ts, qty, supply, is_live, broad_dt, is_censored, sold_out_ts
        FROM censored_grid""",
    "soldout_time": "SELECT pgm_id, prd_cd, attr_prd_cd, total_qty, sold_out_dtm, sold_out_flag FROM soldout_time",
    "soldout_snapshot": "SELECT pgm_id, prd_cd, soldout_seq, attr_prd_cd, value, broad_dt FROM soldout_snapshot",
    "first_soldout_value": "SELECT pgm_id, prd_cd, attr_prd_cd, value FROM soldout_snapshot WHERE soldout_seq = 1",
    "train_set_profile": f"""
        SELECT pgm_id, prd_cd, n_options, n_zero_options, n_train_options, n_observed, n_censored, max_observed,
               trainable, CASE WHEN trainable THEN {_RANK_POOL} END AS rank_pool
        FROM train_set_profile""",
    "observed_demand": """
        SELECT pgm_id, prd_cd, attr_prd_cd, CAST(sum(qty) FILTER (WHERE NOT is_censored) AS BIGINT) AS observed_qty,
               count(*) FILTER (WHERE is_censored) AS n_censored
        FROM censored_grid GROUP BY pgm_id, prd_cd, attr_prd_cd""",
    "group_gate": "SELECT pgm_id, prd_cd, n_report_rows, n_grid_options, passes FROM gate",
    "report_presentation": _PRESENT,
    "month_days": """
        SELECT broad_month, strftime(d, '%Y%m%d') AS broad_dt
        FROM (SELECT broad_month,
                     unnest(generate_series(strptime(broad_month || '01', '%Y%m%d'),
                                            strptime(broad_month || '01', '%Y%m%d') + INTERVAL 1 MONTH - INTERVAL 1 DAY,
                                            INTERVAL 1 DAY)) AS d
              FROM (SELECT DISTINCT substr(broad_dt, 1, 6) AS broad_month FROM broadcast) m) s""",
    "imputation_contract": """
        SELECT pgm_id, prd_cd, count(*) AS n_cells, count(*) FILTER (WHERE NOT is_censored) AS n_kept,
               count(*) FILTER (WHERE is_censored AND trainable) AS n_filled,
               count(*) FILTER (WHERE is_censored AND NOT trainable) AS n_empty, CAST(0 AS BIGINT) AS n_outside
        FROM censored_grid JOIN train_set_profile USING (pgm_id, prd_cd) GROUP BY pgm_id, prd_cd""",
    "final_report_without_estimate": _PRESENT,
    "report_load_roundtrip": _PRESENT,
    "soldout_time_one_day": """
        SELECT pgm_id, prd_cd, attr_prd_cd, total_qty, sold_out_dtm, sold_out_flag FROM soldout_time
        WHERE pgm_id IN (SELECT pgm_id FROM broadcast WHERE broad_dt = '19960101' AND chanl_cd = 'C')""",
    "versioned_load_roundtrip": """
        , kept AS (SELECT r.broad_dt, r.attr_prd_cd, coalesce(r.tot_ord_qty, 0) AS units
                   FROM report_base r SEMI JOIN (SELECT pgm_id, prd_cd FROM gate WHERE passes) USING (pgm_id, prd_cd)),
        first_day AS (SELECT min(broad_dt) AS d FROM kept),
        stored AS (
            SELECT s.step, 'soldout_report' AS tbl, k.broad_dt, k.units
            FROM kept k, first_day f, (VALUES ('loaded'), ('failed'), ('reloaded'), ('first version')) s(step)
            WHERE step <> 'reloaded' OR k.broad_dt <> f.d OR k.attr_prd_cd % 2 = 0
            UNION ALL
            SELECT s.step, 'soldout_snapshot', k.broad_dt, k.value + CASE WHEN step = 'reloaded' AND k.broad_dt = f.d THEN 1 ELSE 0 END
            FROM soldout_snapshot k, first_day f, (VALUES ('loaded'), ('failed'), ('reloaded'), ('first version')) s(step))
        SELECT step, tbl, broad_dt, count(*) AS n_rows, CAST(sum(units) AS BIGINT) AS units FROM stored GROUP BY ALL""",
    "airing_state": """
        SELECT a.pgm_id, a.prd_cd, a.chanl_cd, a.broad_seq, f.myshop_fst_broad_dt AS first_dt
        FROM airing a JOIN first_airing f USING (prd_cd)""",
    "backfill_changes": """
        , kept AS (SELECT r.broad_dt, sum(coalesce(r.tot_ord_qty, 0)) AS units, sum(coalesce(o.onair_lines, 0)) AS more
                   FROM report_base r SEMI JOIN (SELECT pgm_id, prd_cd FROM gate WHERE passes) g USING (pgm_id, prd_cd)
                   LEFT JOIN (SELECT pgm_id, attr_prd_cd, sum(onair_lines) AS onair_lines FROM option_orders GROUP BY ALL) o
                     ON o.pgm_id = r.pgm_id AND o.attr_prd_cd = r.attr_prd_cd
                   GROUP BY r.broad_dt ORDER BY r.broad_dt LIMIT 2),
        last_day AS (SELECT max(broad_dt) AS d FROM kept)
        SELECT s.step, k.broad_dt, s.step = 'first' OR (s.step = 'changed' AND k.broad_dt = l.d) AS computed,
               CAST(k.units + CASE WHEN s.step = 'changed' AND k.broad_dt = l.d THEN k.more ELSE 0 END AS BIGINT) AS units
        FROM kept k, last_day l, (VALUES ('first'), ('again'), ('changed')) s(step)""",
    "load_audit": """
        SELECT coalesce(v.pgm_id, g.pgm_id) AS pgm_id, coalesce(v.prd_cd, g.prd_cd) AS prd_cd, coalesce(v.n, 0) AS n_report_rows,
               coalesce(g.n_grid_options, 0) AS n_grid_options,
               CASE WHEN g.passes IS NULL THEN 'no order on air' WHEN g.passes THEN 'kept' ELSE 'options differ' END AS outcome,
               b.broad_dt
        FROM (SELECT pgm_id, prd_cd, count(*) AS n FROM view_opts GROUP BY ALL) v
        FULL JOIN gate g ON g.pgm_id = v.pgm_id AND g.prd_cd = v.prd_cd
        JOIN broadcast b ON b.pgm_id = coalesce(v.pgm_id, g.pgm_id)""",
    "load_metrics": f"""
        , shown AS ({_PRESENT})
        SELECT 'soldout_report' AS tbl, 'rows' AS metric, count(*) AS value FROM shown
        UNION ALL SELECT 'soldout_report', 'null_sold_out_dtm', count(*) - count("일시품절") FROM shown
        UNION ALL SELECT 'soldout_report', 'null_chg_rt', count(*) - count("전환율") FROM shown
        UNION ALL SELECT 'soldout_report', 'null_size_str', count(*) - count("사이즈_체계") FROM shown
        UNION ALL SELECT 'soldout_report', 'null_value', count(*) - count("첫일시품절시_수량") FROM shown
        UNION ALL SELECT 'soldout_snapshot', 'rows', count(*) FROM soldout_snapshot
        UNION ALL SELECT 'soldout_snapshot', 'null_value', 0""",
    "target_key_check": """
        , kept AS (SELECT r.pgm_id, r.attr_prd_cd, r.broad_dt
                   FROM report_base r SEMI JOIN (SELECT pgm_id, prd_cd FROM gate WHERE passes) USING (pgm_id, prd_cd))
        SELECT pgm_id, attr_prd_cd, broad_dt FROM kept WHERE broad_dt = (SELECT min(broad_dt) FROM kept)""",
    "daily_load_roundtrip": "SELECT pgm_id, soldout_seq, attr_prd_cd, value, broad_dt FROM soldout_snapshot",
}

_CELL = "pgm_id, prd_cd, attr_prd_cd, ord_ts, qty, is_censored, broad_dt, qty_imputed"
_WITH_RANK_ONE = {
    "demand_rank_one": f"SELECT {_CELL} FROM rank_one",
    "estimated_demand_rank_one": "SELECT pgm_id, prd_cd, attr_prd_cd, estim_qty, observed_qty FROM estimated_rank_one",
    "final_report_rank_one": f"""
        SELECT p.*, e.estim_qty AS "추정_기대수요_수량" FROM ({_PRESENT}) p
        LEFT JOIN estimated_rank_one e ON e.pgm_id = p."방송코드" AND e.prd_cd = p."상품코드" AND e.attr_prd_cd = p."속성코드"
    """,
}
_FINAL["minute_orders_sql"], _FINAL["report_base_sql"] = _FINAL["minute_orders"], _FINAL["report_base"]
_FINAL["demand_sgd_contract"] = _FINAL["imputation_contract"]


def oracle_sql() -> dict[str, str]:
    pre = _prelude()
    out = {name: pre + body for name, body in _FINAL.items()}
    with_model = pre.rstrip() + ",\n" + _rank_one().strip() + "\n"
    out.update({name: with_model + body for name, body in _WITH_RANK_ONE.items()})
    return out
