"""The per-broadcast, per-option report base: one DataFrame per block of the warehouse query.

Blocks: ``broadcasts`` (broadcast x product of the run, with its n-th airing), ``products``
(options of those products), ``attr_info`` (colour count, size list), ``minutes``
(exposure), ``supply`` (promised quantity per representative option), ``order_base`` (order
lines in the broadcast's two-day window) and its aggregates, then ``report_base`` joins them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockout.functions import day_after, ordered_size_string, size_sort_key, strip_paren
from stockout.operators.scope import ALL, LIVE_CHANNEL, Scope
from stockout.sources import Sources

ON_AIR, PRE_ORDER = "O1", "P1"


def broadcast_sequence(src: Sources, scope: Scope = ALL, numbered: DataFrame | None = None) -> DataFrame:
    """Broadcast x product x listed channel rows of the run, with ``broad_seq`` = the n-th airing of the
    product on that channel over the whole history (dense rank by start time).

    The rank must see all history, so the run's filter is applied to the ranked rows; the
    history is first cut to the run's products by a semi-join, which is safe because the
    product is a partition key of the rank. ``numbered``: the run's airings with their number if a kept
    state has them (``airings.AiringState``); then no history is read.
    """
    run = (scope.broadcasts(src.broadcast)
           .select("pgm_id", F.col("chanl_cd").alias("run_chanl_cd"), "broad_dt",
                   "broad_str_dtm", "pgm_nm"))
    listed = src.broadcast_product.select("pgm_id", "prd_cd", "chanl_cd").distinct()
    history = listed.join(src.broadcast.select("pgm_id", "broad_str_dtm"), "pgm_id")
    if scope != ALL and numbered is None:
        run_products = listed.join(run, "pgm_id", "left_semi").select("prd_cd")
        history = history.join(run_products, "prd_cd", "left_semi")
    airing = history.select(
        "pgm_id", "prd_cd", "chanl_cd",
        F.dense_rank().over(Window.partitionBy("prd_cd", "chanl_cd").orderBy("broad_str_dtm"))
        .cast("int").alias("broad_seq"))
    if numbered is not None:
        airing = numbered.select("pgm_id", "prd_cd", "chanl_cd", "broad_seq")
    return (run.join(listed, "pgm_id")
            .join(airing, ["pgm_id", "prd_cd", "chanl_cd"])
            .join(src.product.select("prd_cd"), "prd_cd", "left_semi")
            .select("pgm_id", "prd_cd", "chanl_cd", "broad_str_dtm", "broad_dt", "pgm_nm",
                    "broad_seq", "run_chanl_cd",
                    (F.col("run_chanl_cd") == LIVE_CHANNEL).alias("is_live")))


def product_attributes(src: Sources, pgm: DataFrame) -> DataFrame:
    """Options (colour/size) of the run's products, with product and item names."""
    products = pgm.select("prd_cd").distinct()
    return (src.product
            .join(products, "prd_cd", "left_semi")
            .join(src.attr_product, "prd_cd")
            .join(src.item, "item_cd")
            .select("prd_cd", "md_id", "prd_nm", "item_nm", "item_cd", "attr_prd_cd",
                    F.substring("fst_broad_dt", 1, 4).alias("fst_broad_yyyy"),
                    F.substring("fst_broad_dt", 5, 2).alias("fst_broad_mm"),
                    "fst_broad_dt", "fst_prd_sale_prc", "attr_prd_rep_cd", "attr_prd_whl_val",
                    "attr_prd_1_val", strip_paren(F.col("attr_prd_2_val")).alias("attr_prd_2_val"),
                    F.col("attr_prd_2_val").alias("attr_prd_2_val_org")))


def product_attr_info(prd: DataFrame) -> DataFrame:
    """Per product: number of distinct colours and the ordered, '_'-joined distinct sizes."""
    colours = prd.groupBy("prd_cd").agg(F.count_distinct("attr_prd_1_val").alias("color_cnt"))
    sizes = (prd.select("prd_cd", "attr_prd_2_val").distinct()
             .withColumn("size_key", size_sort_key(F.col("attr_prd_2_val")))
             .groupBy("prd_cd")
             .agg(ordered_size_string("attr_prd_2_val", "size_key").alias("size_str")))
    return colours.join(sizes, "prd_cd")


def exposure_minutes(src: Sources, pgm: DataFrame) -> DataFrame:
    """Weighted and exposure seconds per broadcast x product (reduced to the run first)."""
    return (src.target_minutes
            .join(pgm.select("pgm_id", "prd_cd"), ["pgm_id", "prd_cd"], "left_semi")
            .groupBy("pgm_id", "prd_cd")
            .agg(F.sum("weiht_mi").alias("weiht_mi"), F.sum("expos_mi").alias("expos_mi")))


def supply_by_attr(src: Sources, pgm: DataFrame) -> DataFrame:
    """Promised supply per broadcast x product x representative option; plans in state '0'
    (and plans without a state) are left out."""
    plans = (src.supply_plan.where(F.col("broad_bef_mng_prg_st_cd") != "0")
             .select("suply_plan_mng_no", "pgm_id", "prd_cd"))
    return (plans.join(src.supply_appointment, ["suply_plan_mng_no", "prd_cd"])
            .join(pgm.select("pgm_id", "prd_cd"), ["pgm_id", "prd_cd"], "left_semi")
            .groupBy("pgm_id", "prd_cd", "attr_prd_rep_cd")
            .agg(F.sum("suply_apnt_qty").alias("suply_apnt_qty")))


def _counted_lines(src: Sources, scope: Scope) -> DataFrame:
    """Order lines of real customers, on air or pre-ordered, of the run's order days."""
    orders = src.order_fact.where(
        F.col("broad_ord_time_dtl_cd").isin(PRE_ORDER, ON_AIR) & (F.col("tot_ord_cust_no") > 0))
    bounds = scope.order_day_bounds()
    return orders if bounds is None else orders.where(F.col("ord_dt").between(*bounds))


def in_broadcast_days(orders: DataFrame, pgm: DataFrame, scope: Scope = ALL) -> DataFrame:
    """Order rows placed on the broadcast day or the day after, for the broadcast x product on the
    product row's channel."""
    window = pgm.select(
        "pgm_id", "prd_cd", F.col("chanl_cd").alias("broad_rlrslt_gbn_cd"), "broad_dt",
        "broad_str_dtm",
        day_after(F.col("broad_dt"), scope.numeric_day_window).alias("last_ord_dt"))
    return (orders.join(window, ["pgm_id", "prd_cd", "broad_rlrslt_gbn_cd"])
            .where((F.col("ord_dt") >= F.col("broad_dt")) & (F.col("ord_dt") <= F.col("last_ord_dt"))))


def order_base(src: Sources, pgm: DataFrame, scope: Scope = ALL) -> DataFrame:
    """Order lines of real customers, on-air or pre-order, placed on the broadcast day or the
    day after, for the broadcast x product on the product row's channel."""
    return in_broadcast_days(_counted_lines(src, scope), pgm, scope)


def _amount(kind: str) -> F.Column:
    """Order amount with supplier discount, coupon per unit and non-accumulating sales; a
    null operand nulls the row's term."""
    qty = F.col(f"{kind}_ord_qty").cast("decimal(18,0)")
    return (F.col(f"{kind}_ord_amt") + F.col(f"sup_shr_{kind}_ord_dc_amt")
            + F.col("cmm_cpn_dc_amt") * qty + F.col(f"{kind}_ord_naccm_sale_amt"))


#: What a line is summed by before it meets the broadcasts.
LINE_MINUTE = ("pgm_id", "prd_cd", "attr_prd_cd", "broad_rlrslt_gbn_cd", "broad_ord_time_dtl_cd", "ord_dt", "ord_time")


def _summed(lines: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Every figure that is asked of order lines, by ``keys``; expected sales are rounded per line."""
    tot = _amount("tot")
    return (lines.groupBy(*keys)
            .agg(F.max("chg_rt").alias("chg_rt"), F.sum(tot).alias("tot_amt"), F.sum(_amount("net")).alias("net_amt"),
                 F.sum(F.round(tot * F.col("chg_rt") * (1 - F.col("naccm_sale_subtr_apply_rt")))).alias("expct_amt"),
                 F.sum("tot_ord_qty").alias("tot_ord_qty"), F.count("*").alias("n_lines")))


def line_minutes(src: Sources, scope: Scope = ALL) -> DataFrame:
    """The order lines summed to option, channel, time code and minute: the run's only pass over them.
    The sum is partial on the map side, so a hot broadcast's lines are shuffled as one row per minute and
    task. The minute grid and the report's order figures are both rolled up from it."""
    return _summed(_counted_lines(src, scope), LINE_MINUTE)


def option_totals(minutes: DataFrame) -> DataFrame:
    """Rows of :func:`line_minutes` in their broadcast's days, rolled up to (broadcast, product, option)."""
    preorder_from = F.date_format(F.date_trunc("DAY", F.col("broad_str_dtm")) + F.expr("INTERVAL 3 HOURS"),
                                  "yyyyMMddHHmm")
    preorder_to = F.date_format(F.col("broad_str_dtm"), "yyyyMMddHHmm")
    in_preorder = F.concat("ord_dt", "ord_time").between(preorder_from, preorder_to)
    on_air = F.col("broad_ord_time_dtl_cd") == ON_AIR
    return (minutes.groupBy("pgm_id", "prd_cd", "attr_prd_cd")
            .agg(F.max("chg_rt").alias("chg_rt"), F.sum("tot_amt").alias("tot_amt"), F.sum("net_amt").alias("net_amt"),
                 F.sum("expct_amt").alias("expct_amt"),
                 F.sum(F.when(in_preorder, F.col("tot_ord_qty"))).alias("pord_03_tot_ord_qty"),
                 F.sum(F.when(on_air, F.col("tot_ord_qty"))).alias("tot_ord_qty"),
                 F.coalesce(F.sum(F.when(on_air, F.col("n_lines"))), F.lit(0)).alias("n_onair_lines")))


def order_option_totals(base: DataFrame) -> DataFrame:
    """The same from order lines that have met their broadcasts (:func:`order_base`)."""
    return option_totals(_summed(base, (*LINE_MINUTE, "broad_str_dtm")))


def order_revenue(totals: DataFrame) -> DataFrame:
    """Per broadcast x product: max conversion rate, total and net amount, expected sales
    (rounded per order line before summing)."""
    return (totals.groupBy("pgm_id", "prd_cd")
            .agg(F.max("chg_rt").alias("chg_rt"), F.sum("tot_amt").alias("tot_ord_amt"),
                 F.sum("net_amt").alias("net_ord_amt"), F.sum("expct_amt").alias("expct_sal_amt")))


def option_quantities(totals: DataFrame) -> DataFrame:
    """Per broadcast x option: pre-orders since 03:00 of the broadcast day up to its start
    minute (null if none) and on-air quantity (null if none)."""
    return (totals.groupBy("pgm_id", "attr_prd_cd")
            .agg(F.max("prd_cd").alias("ord_prd_cd"),
                 F.sum("pord_03_tot_ord_qty").alias("pord_03_tot_ord_qty"),
                 F.sum("tot_ord_qty").alias("tot_ord_qty"),
                 F.sum("n_onair_lines").alias("n_onair_lines")))


def first_broadcast(src: Sources, prd: DataFrame) -> DataFrame:
    """First-ever broadcast day of each product of the run."""
    products = prd.select("prd_cd").distinct()
    return (src.broadcast_product.select("pgm_id", "prd_cd")
            .join(products, "prd_cd", "left_semi")
            .join(src.broadcast.select("pgm_id", "broad_dt"), "pgm_id")
            .groupBy("prd_cd").agg(F.min("broad_dt").alias("myshop_fst_broad_dt")))


# The report base's columns, in order.
REPORT_BASE_COLUMNS = (
    "item_nm", "item_cd", "prd_nm", "prd_cd", "size_str", "color_cnt", "fst_broad_yyyy",
    "fst_broad_mm", "attr_prd_cd", "chanl_cd", "broad_seq", "attr_prd_1_val", "attr_prd_2_val_org",
    "attr_prd_2_val", "attr_prd_whl_val", "suply_apnt_qty", "tot_ord_qty", "pord_03_tot_ord_qty",
    "tot_ord_amt", "net_ord_amt", "chg_rt", "pgm_id", "pgm_nm", "broad_dt", "broad_str_dtm",
    "expct_sal_amt_per_wmi", "weiht_mi", "expos_mi", "myshop_fst_broad_dt", "md_id",
    "fst_broad_dt", "fst_prd_sale_prc")


def report_base(src: Sources, scope: Scope = ALL, *, keep_run_columns: bool = False,
                pgm: DataFrame | None = None, prd: DataFrame | None = None,
                totals: DataFrame | None = None) -> DataFrame:
    """One row per broadcast x option of the run with sales, supply and exposure figures.

    ``pgm`` / ``prd`` / ``totals``: the run's ``broadcast_sequence`` / ``product_attributes`` /
    ``option_totals`` if already built (a run writes them once; the blocks below read
    them; otherwise revenue and quantities would each re-scan the order lines, pruned to
    different columns). All right-hand sides are
    aggregates far smaller than the order lines; AQE turns their joins into broadcast joins
    when their measured size allows it.
    """
    pgm = broadcast_sequence(src, scope) if pgm is None else pgm
    prd = product_attributes(src, pgm) if prd is None else prd
    totals = option_totals(in_broadcast_days(line_minutes(src, scope), pgm, scope)) if totals is None else totals
    qty = option_quantities(totals)
    weiht = F.col("weiht_mi")
    out = (prd.join(pgm, "prd_cd")
           .join(product_attr_info(prd), "prd_cd", "left")
           .join(exposure_minutes(src, pgm), ["pgm_id", "prd_cd"], "left")
           .join(supply_by_attr(src, pgm), ["pgm_id", "prd_cd", "attr_prd_rep_cd"], "left")
           .join(order_revenue(totals), ["pgm_id", "prd_cd"], "left")
           .join(qty, ["pgm_id", "attr_prd_cd"], "left")
           .join(first_broadcast(src, prd), "prd_cd", "left")
           .withColumns({
               "suply_apnt_qty": F.coalesce(F.col("suply_apnt_qty"), F.lit(0)).cast("bigint"),
               "pord_03_tot_ord_qty": F.when(F.col("ord_prd_cd") == F.col("prd_cd"),
                                             F.col("pord_03_tot_ord_qty")),
               "tot_ord_amt": F.ceil(F.col("tot_ord_amt") / 1000).cast("bigint"),
               "net_ord_amt": F.ceil(F.col("net_ord_amt") / 1000).cast("bigint"),
               "chg_rt": F.col("chg_rt").cast("double"),
               "expct_sal_amt_per_wmi": F.when(
                   weiht > 0,
                   F.round(F.col("expct_sal_amt").cast("double") / (weiht / 60))).otherwise(0).cast("bigint"),
               "weiht_mi": F.round(weiht / 60).cast("bigint"),
               "expos_mi": F.round(F.col("expos_mi") / 60).cast("bigint"),
               "fst_prd_sale_prc": F.col("fst_prd_sale_prc").cast("double"),
           }))
    cols = list(REPORT_BASE_COLUMNS) + (["run_chanl_cd", "is_live"] if keep_run_columns else [])
    return out.select(*cols)


def report_options(src: Sources, scope: Scope = ALL, *, pgm: DataFrame | None = None,
                   prd: DataFrame | None = None) -> DataFrame:
    """The report's options with their supply and run channel, without any order figure:
    what the sold-out rule needs from the report (supply is 0 where no plan exists)."""
    pgm = broadcast_sequence(src, scope) if pgm is None else pgm
    prd = product_attributes(src, pgm) if prd is None else prd
    return (prd.join(pgm, "prd_cd")
            .join(supply_by_attr(src, pgm), ["pgm_id", "prd_cd", "attr_prd_rep_cd"], "left")
            .select("pgm_id", "prd_cd", "attr_prd_cd", "broad_dt", "is_live",
                    F.coalesce(F.col("suply_apnt_qty"), F.lit(0)).cast("bigint").alias("supply")))
