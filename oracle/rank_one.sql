-- Imputation in whole millionths: mean, option and minute biases, one factor. Every quotient is
-- rounded half away from zero. Each step is a sum over the cells left to train on, joined back.
cell AS MATERIALIZED (
    SELECT z.pgm_id, z.prd_cd, z.attr_prd_cd, z.ord_ts, z.qty, z.is_censored, z.broad_dt, t.trainable, t.max_observed AS top,
           NOT z.all_zero AND NOT z.is_censored AS train, CAST(z.qty AS HUGEINT) * 1000000 AS y
    FROM zflag z JOIN train_set_profile t USING (pgm_id, prd_cd)
),
mean AS MATERIALIZED (
    SELECT pgm_id, prd_cd, {mean} AS mean FROM cell WHERE train GROUP BY pgm_id, prd_cd
),
seen AS MATERIALIZED (
    SELECT c.pgm_id, c.prd_cd, c.attr_prd_cd, c.ord_ts, c.y - m.mean AS d FROM cell c JOIN mean m USING (pgm_id, prd_cd) WHERE c.train
),
{steps},
estimate AS (
    SELECT c.*, least(greatest(m.mean + coalesce(b.v, 0) + coalesce(d.v, 0) + {product}, 0), CAST(c.top AS HUGEINT) * 1000000) AS v
    FROM cell c
    LEFT JOIN mean m USING (pgm_id, prd_cd)
    LEFT JOIN {last_option_bias} b USING (pgm_id, prd_cd, attr_prd_cd)
    LEFT JOIN {last_minute_bias} d USING (pgm_id, prd_cd, ord_ts)
    LEFT JOIN {last_option_factor} f USING (pgm_id, prd_cd, attr_prd_cd)
    LEFT JOIN {last_minute_factor} g USING (pgm_id, prd_cd, ord_ts)
),
rank_one AS (
    SELECT pgm_id, prd_cd, attr_prd_cd, ord_ts, qty, is_censored, broad_dt,
           CAST(CASE WHEN NOT is_censored THEN qty
                     WHEN trainable THEN v // 1000000 + CASE WHEN v % 1000000 > 500000 THEN 1 WHEN v % 1000000 < 500000 THEN 0
                                                             ELSE (v // 1000000) % 2 END END AS DOUBLE) AS qty_imputed
    FROM estimate
),
estimated_rank_one AS (
    SELECT pgm_id, prd_cd, attr_prd_cd, CAST(coalesce(sum(qty_imputed), 0) AS BIGINT) AS estim_qty,
           CAST(sum(qty) FILTER (WHERE NOT is_censored) AS BIGINT) AS observed_qty
    FROM rank_one GROUP BY pgm_id, prd_cd, attr_prd_cd
)
