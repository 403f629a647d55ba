"""Declared schemas of the sources and results, and the report's column names.

Names are lower case inside the library; the report's display names (Korean) are applied
only at presentation time.
"""

from __future__ import annotations

from pyspark.sql import types as T

BIGINT, INT, STR = T.LongType(), T.IntegerType(), T.StringType()
DBL, TS, BOOL = T.DoubleType(), T.TimestampNTZType(), T.BooleanType()
AMT, RATE = T.DecimalType(18, 2), T.DecimalType(4, 2)


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "broadcast": _schema(("pgm_id", BIGINT), ("chanl_cd", STR), ("broad_dt", STR),
                         ("broad_str_dtm", TS), ("pgm_nm", STR)),
    "broadcast_product": _schema(("pgm_id", BIGINT), ("prd_cd", BIGINT), ("chanl_cd", STR)),
    "product": _schema(("prd_cd", BIGINT), ("prd_nm", STR), ("item_cd", BIGINT), ("md_id", STR),
                       ("fst_broad_dt", STR), ("fst_prd_sale_prc", AMT)),
    "item": _schema(("item_cd", BIGINT), ("item_nm", STR)),
    "attr_product": _schema(("prd_cd", BIGINT), ("attr_prd_cd", BIGINT), ("attr_prd_rep_cd", BIGINT),
                            ("attr_prd_1_val", STR), ("attr_prd_2_val", STR), ("attr_prd_whl_val", STR)),
    "order_fact": _schema(
        ("pgm_id", BIGINT), ("prd_cd", BIGINT), ("attr_prd_cd", BIGINT), ("ord_dt", STR),
        ("ord_time", STR), ("tot_ord_qty", BIGINT), ("net_ord_qty", BIGINT), ("tot_ord_amt", AMT),
        ("net_ord_amt", AMT), ("sup_shr_tot_ord_dc_amt", AMT), ("sup_shr_net_ord_dc_amt", AMT),
        ("cmm_cpn_dc_amt", AMT), ("tot_ord_naccm_sale_amt", AMT), ("net_ord_naccm_sale_amt", AMT),
        ("naccm_sale_subtr_apply_rt", RATE), ("chg_rt", RATE), ("broad_rlrslt_gbn_cd", STR),
        ("broad_ord_time_dtl_cd", STR), ("tot_ord_cust_no", INT)),
    "target_minutes": _schema(("pgm_id", BIGINT), ("prd_cd", BIGINT), ("weiht_mi", BIGINT),
                              ("expos_mi", BIGINT)),
    "supply_plan": _schema(("suply_plan_mng_no", BIGINT), ("pgm_id", BIGINT), ("prd_cd", BIGINT),
                           ("suply_psbl_qty", BIGINT), ("pgm_tgt_qty", BIGINT),
                           ("broad_bef_mng_prg_st_cd", STR)),
    "supply_appointment": _schema(("suply_plan_mng_no", BIGINT), ("prd_cd", BIGINT),
                                  ("attr_prd_rep_cd", BIGINT), ("suply_apnt_qty", BIGINT)),
}

# Report columns in the reference's order (English key -> Korean display name).
# They must equal the reference's names for the written table to be a drop-in replacement.
REPORT_COLUMN_NAMES: dict[str, str] = {
    "item_nm": "아이템명", "item_cd": "아이템코드", "size_str": "사이즈_체계", "color_cnt": "컬러수",
    "prd_nm": "상품명", "prd_cd": "상품코드", "fst_broad_yyyy": "런칭년도", "fst_broad_mm": "런칭월",
    "attr_prd_cd": "속성코드", "chanl_cd": "방송채널코드", "broad_seq": "방송회차", "pgm_id": "방송코드",
    "attr_prd_1_val": "컬러", "attr_prd_2_val_org": "사이즈", "attr_prd_2_val": "사이즈_변환",
    "size2": "사이즈2", "size3": "사이즈3", "sold_out_flag": "품절여부", "sold_out_dtm": "일시품절",
    "suply_apnt_qty": "공급약속수량", "pord_03_tot_ord_qty": "미리주문", "value": "첫일시품절시_수량",
    "estim_qty": "추정_기대수요_수량", "tot_ord_qty": "실제_총주문_수량", "pgm_nm": "프로그램명",
    "broad_dt": "방송일자", "broad_str_dtm": "방송일자시간", "pgm_time": "방송시간",
    "tot_ord_amt": "총주문_천원", "net_ord_amt": "순주문_천원", "chg_rt": "전환율", "expos_mi": "노출분",
    "weiht_mi": "가중분", "expct_sal_amt_per_wmi": "가중분취", "attr_prd_whl_val": "상품속성값",
    "myshop_fst_broad_dt": "데이터런칭일자", "md_id": "MDID", "fst_broad_dt": "라이브런칭일자",
    "fst_prd_sale_prc": "최초판매가",
}

# Types of the 39 report columns (English keys). Nullable numbers stay numbers, nulls stay null.
# The type of each report column.
REPORT_TYPES: dict[str, T.DataType] = {
    "attr_prd_1_val": STR, "attr_prd_2_val": STR, "attr_prd_2_val_org": STR, "attr_prd_cd": BIGINT,
    "attr_prd_whl_val": STR, "broad_dt": STR, "broad_seq": INT, "broad_str_dtm": TS,
    "chanl_cd": STR, "chg_rt": DBL, "color_cnt": BIGINT, "estim_qty": BIGINT,
    "expct_sal_amt_per_wmi": BIGINT, "expos_mi": BIGINT, "fst_broad_mm": INT, "fst_broad_yyyy": INT,
    "item_cd": BIGINT, "item_nm": STR, "myshop_fst_broad_dt": BIGINT, "net_ord_amt": BIGINT,
    "pgm_id": BIGINT, "pgm_nm": STR, "pgm_time": STR, "pord_03_tot_ord_qty": BIGINT,
    "prd_cd": BIGINT, "prd_nm": STR, "size2": STR, "size3": STR, "size_str": STR,
    "sold_out_dtm": TS, "sold_out_flag": INT, "suply_apnt_qty": BIGINT, "tot_ord_amt": BIGINT,
    "tot_ord_qty": BIGINT, "value": BIGINT, "weiht_mi": BIGINT, "md_id": STR,
    "fst_broad_dt": STR, "fst_prd_sale_prc": DBL,
}

REPORT_KEY = ("pgm_id", "attr_prd_cd")
SNAPSHOT_SCHEMA = _schema(("pgm_id", BIGINT), ("soldout_seq", INT), ("attr_prd_cd", BIGINT),
                          ("value", BIGINT), ("broad_dt", STR))
SNAPSHOT_KEY = ("pgm_id", "attr_prd_cd", "soldout_seq", "broad_dt")
