"""DuckDB side of the checks: shared CTEs and expressions.

The SQL joins customers to orders to find exposed users, where the Spark side
reads the arm from the hash, so the two derivations check each other.
"""

from __future__ import annotations

from workload.fixtures import EXPERIMENTS

_WINDOWS = ", ".join(f"('{e}', TIMESTAMP '{a}', TIMESTAMP '{b}')" for e, a, b in EXPERIMENTS)

BASE = f"""
WITH registry AS (
  SELECT * FROM (VALUES {_WINDOWS}) AS t(experiment_id, start_ts, end_ts)
),
hashed AS (
  SELECT r.*, c.*, c.c_custkey::VARCHAR AS user_id,
         ('0x' || substr(md5(r.experiment_id || ':' || c.c_custkey::VARCHAR), 1, 8))::BIGINT AS h
  FROM customer c CROSS JOIN registry r
),
everyone AS (
  SELECT *, CASE WHEN (h // 100) % 100 < 50 THEN 'treatment' ELSE 'control' END AS variant,
         start_ts + to_days((h % 28)::INTEGER) AS exposure_ts, 'user_id' AS unit
  FROM hashed
),
assigned AS (
  SELECT * FROM everyone WHERE h % 100 < 85
),
exposures AS (
  SELECT experiment_id, user_id, variant, exposure_ts, unit FROM assigned
),
exposures_raw AS (
  SELECT * FROM exposures
  UNION ALL
  SELECT experiment_id, user_id, CASE variant WHEN 'control' THEN 'treatment' ELSE 'control' END,
         exposure_ts + INTERVAL 1 DAY, unit
  FROM assigned WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT experiment_id, user_id, 'holdout', exposure_ts + INTERVAL 2 DAY, 'device_id'
  FROM assigned WHERE c_mktsegment = 'MACHINERY'
  UNION ALL
  SELECT experiment_id, NULL, variant, exposure_ts, unit FROM assigned WHERE c_acctbal < 0
),
visits AS (
  SELECT a.experiment_id, a.user_id, a.variant, a.exposure_ts, a.start_ts, a.end_ts,
         o.o_orderstatus, o.o_totalprice / 1000 AS amount, o.o_orderdate AS placed,
         CASE WHEN o.o_orderkey % 97 > 0 THEN o.o_orderdate END AS ts
  FROM everyone a JOIN orders o ON o.o_custkey = a.c_custkey
),
outcomes AS (
  SELECT experiment_id, user_id, 'pre_revenue' AS metric_name, amount AS value, ts
  FROM visits WHERE placed < exposure_ts
  UNION ALL
  SELECT experiment_id, user_id, 'revenue', amount, ts FROM visits WHERE placed >= exposure_ts
  UNION ALL
  SELECT experiment_id, user_id, 'conversion', CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END::DOUBLE, ts
  FROM visits WHERE placed >= exposure_ts
),
keyed AS (
  SELECT *, o_orderkey % 100 AS digit,
         CASE WHEN o_orderpriority < '3' THEN o_orderkey || '/' || metric_name END AS event_id
  FROM (
    SELECT a.experiment_id, a.user_id, o.o_orderkey, o.o_orderpriority,
           CASE WHEN o.o_orderkey % 97 > 0 THEN o.o_orderdate END AS ts,
           unnest(CASE WHEN o.o_orderdate < a.exposure_ts THEN ['pre_revenue'] ELSE ['revenue', 'conversion'] END) AS metric_name,
           o.o_totalprice / 1000 AS amount, o.o_orderstatus
    FROM everyone a JOIN orders o ON o.o_custkey = a.c_custkey)
),
keyed_outcomes AS (
  SELECT *, CASE WHEN metric_name <> 'conversion' THEN amount WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END::DOUBLE AS value
  FROM keyed
),
replayed AS (
  SELECT experiment_id, user_id, metric_name, ts, event_id,
         CASE WHEN event_id IS NULL THEN value END AS same, min(value) AS value,
         coalesce(date_trunc('month', ts)::DATE, DATE '0001-01-01') AS batch,
         sum(CASE WHEN event_id IS NOT NULL THEN CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END
                  WHEN month(ts) % 2 = 1 THEN 3 ELSE 1 END)::BIGINT AS copies,
         bool_or(event_id IS NOT NULL AND o_orderkey % 25 = 0) AS conflicting
  FROM keyed_outcomes GROUP BY ALL
),
factors AS (
  SELECT experiment_id, batch, CASE WHEN count(*) < 20 THEN 1 ELSE list_reduce(list(copies), lambda a, b: gcd(a, b)) END AS factor
  FROM replayed WHERE event_id IS NULL GROUP BY ALL
),
unrepeated AS (
  SELECT r.*, coalesce(factor, 1) AS factor, CASE WHEN event_id IS NULL THEN copies // coalesce(factor, 1) ELSE 1 END AS kept
  FROM replayed r LEFT JOIN factors f USING (experiment_id, batch)
),
order_values AS (
  SELECT r.experiment_id, r.start_ts, o.o_custkey::VARCHAR AS user_id, 'order_value' AS metric_name,
         o.o_totalprice / 1000 AS value, o.o_orderdate AS ts
  FROM orders o CROSS JOIN registry r
),
event_outcomes AS (
  SELECT 'exp_events' AS experiment_id, user_id::VARCHAR AS user_id, event_type AS metric_name, value, ts
  FROM events
),
joined AS (
  SELECT o.experiment_id, o.user_id, o.metric_name, o.value, o.ts, e.variant, e.exposure_ts
  FROM outcomes o JOIN exposures e USING (experiment_id, user_id)
),
users AS (
  SELECT e.experiment_id, e.user_id, e.variant,
         coalesce(max(o.value) FILTER (o.metric_name = 'conversion'), 0) AS conversion,
         coalesce(sum(o.value) FILTER (o.metric_name = 'revenue'), 0) AS revenue,
         coalesce(sum(o.value) FILTER (o.metric_name = 'pre_revenue'), 0) AS pre_revenue
  FROM exposures e LEFT JOIN outcomes o USING (experiment_id, user_id)
  GROUP BY ALL
),
user_metric AS (
  SELECT experiment_id, user_id, variant, 'conversion' AS metric_name, conversion AS value FROM users
  UNION ALL SELECT experiment_id, user_id, variant, 'revenue', revenue FROM users
  UNION ALL SELECT experiment_id, user_id, variant, 'pre_revenue', pre_revenue FROM users
),
arm_stats AS (
  SELECT experiment_id, metric_name, variant, count(*) AS n, avg(value) AS mean,
         var_samp(value) AS var, stddev_samp(value) AS std
  FROM user_metric GROUP BY ALL
),
paired AS (
  SELECT c.experiment_id, c.metric_name,
         c.n AS n_control, c.mean AS mean_control, c.var AS var_control, c.std AS std_control,
         t.n AS n_treatment, t.mean AS mean_treatment, t.var AS var_treatment, t.std AS std_treatment,
         t.mean - c.mean AS delta, (t.mean - c.mean) / nullif(c.mean, 0) AS rel_lift
  FROM arm_stats c JOIN arm_stats t USING (experiment_id, metric_name)
  WHERE c.variant = 'control' AND t.variant = 'treatment'
),
tested AS (
  SELECT *,
         CASE WHEN metric_name = 'conversion' THEN
           sqrt(mean_control * (1 - mean_control) / n_control + mean_treatment * (1 - mean_treatment) / n_treatment)
         ELSE sqrt(var_control / n_control + var_treatment / n_treatment) END AS se,
         CASE WHEN metric_name = 'conversion' THEN
           sqrt((mean_control * n_control + mean_treatment * n_treatment) / (n_control + n_treatment)
                * (1 - (mean_control * n_control + mean_treatment * n_treatment) / (n_control + n_treatment))
                * (1.0 / n_control + 1.0 / n_treatment))
         ELSE sqrt(var_control / n_control + var_treatment / n_treatment) END AS test_se,
         CASE WHEN metric_name = 'conversion' THEN 'two_proportion_z' ELSE 'welch_normal_approx' END AS method
  FROM paired
),
ab AS (
  SELECT experiment_id, metric_name, n_control, mean_control, std_control,
         n_treatment, mean_treatment, std_treatment, delta, rel_lift, se, delta / test_se AS z,
         @P(delta / test_se)@ AS p_value, delta - 1.96 * se AS ci_low, delta + 1.96 * se AS ci_high, method
  FROM tested
),
cases AS (
  SELECT e.experiment_id, e.user_id, e.variant,
         sum(o.value) FILTER (o.metric_name = 'revenue') AS y,
         sum(o.value) FILTER (o.metric_name = 'pre_revenue') AS x
  FROM exposures e JOIN outcomes o USING (experiment_id, user_id)
  GROUP BY ALL HAVING y IS NOT NULL AND x IS NOT NULL
),
theta AS (
  SELECT experiment_id, count(*) AS n, avg(x) AS x_mean, var_samp(x) AS x_var,
         covar_samp(y, x) AS yx_covar, covar_samp(y, x) / var_samp(x) AS theta
  FROM cases GROUP BY ALL
),
adjusted AS (
  SELECT c.*, t.theta, t.x_mean, c.y - t.theta * (c.x - t.x_mean) AS y_cuped
  FROM cases c JOIN theta t USING (experiment_id)
),
cuped_arm AS (
  SELECT experiment_id, variant, count(*) AS n, any_value(theta) AS theta, any_value(x_mean) AS x_mean,
         avg(y) AS mean_raw, var_samp(y) AS var_raw, avg(y_cuped) AS mean_cuped, var_samp(y_cuped) AS var_cuped
  FROM adjusted GROUP BY experiment_id, variant
),
cuped_pair AS (
  SELECT c.experiment_id, c.theta, c.x_mean, c.n AS n_control, t.n AS n_treatment,
         c.mean_raw AS mean_control_raw, c.mean_cuped AS mean_control_cuped,
         t.mean_raw AS mean_treatment_raw, t.mean_cuped AS mean_treatment_cuped,
         c.var_cuped AS var_control_cuped, t.var_cuped AS var_treatment_cuped,
         t.mean_raw - c.mean_raw AS delta_raw, sqrt(c.var_raw / c.n + t.var_raw / t.n) AS se_raw,
         t.mean_cuped - c.mean_cuped AS delta_cuped, sqrt(c.var_cuped / c.n + t.var_cuped / t.n) AS se_cuped
  FROM cuped_arm c JOIN cuped_arm t USING (experiment_id)
  WHERE c.variant = 'control' AND t.variant = 'treatment'
),
cuped AS (
  SELECT experiment_id, 'revenue' AS metric_name, 'pre_revenue' AS covariate_name, theta, x_mean,
         n_control, mean_control_raw, mean_control_cuped, n_treatment, mean_treatment_raw, mean_treatment_cuped,
         delta_raw, se_raw, delta_raw - 1.96 * se_raw AS ci_low_raw, delta_raw + 1.96 * se_raw AS ci_high_raw,
         @P(delta_raw / se_raw)@ AS p_value_raw,
         delta_cuped, se_cuped, delta_cuped - 1.96 * se_cuped AS ci_low_cuped,
         delta_cuped + 1.96 * se_cuped AS ci_high_cuped, @P(delta_cuped / se_cuped)@ AS p_value_cuped,
         delta_cuped / se_cuped AS z_cuped, var_control_cuped, var_treatment_cuped
  FROM cuped_pair
),
did_cells AS (
  SELECT experiment_id, variant, count(*) AS n, avg(x) AS pre_mean, avg(y) AS post_mean,
         var_samp(x) AS pre_var, var_samp(y) AS post_var
  FROM cases GROUP BY ALL
),
did_pair AS (
  SELECT c.experiment_id, c.n AS n_control, t.n AS n_treatment,
         t.pre_mean AS y_treat_pre, t.post_mean AS y_treat_post, c.pre_mean AS y_ctrl_pre, c.post_mean AS y_ctrl_post,
         (t.post_mean - t.pre_mean) - (c.post_mean - c.pre_mean) AS did,
         sqrt(t.post_var / t.n + t.pre_var / t.n + c.post_var / c.n + c.pre_var / c.n) AS se
  FROM did_cells c JOIN did_cells t USING (experiment_id)
  WHERE c.variant = 'control' AND t.variant = 'treatment'
),
did AS (
  SELECT p.*, r.start_ts, r.end_ts, did / se AS z, @P(did / se)@ AS p_value,
         did - 1.96 * se AS ci_low, did + 1.96 * se AS ci_high
  FROM did_pair p JOIN registry r USING (experiment_id)
),
trend_daily AS (
  SELECT experiment_id, datediff('day', exposure_ts, ts)::INTEGER AS k_days, variant, avg(value) AS mean
  FROM joined WHERE metric_name = 'pre_revenue' AND datediff('day', exposure_ts, ts) < 0
  GROUP BY ALL
),
trend_all AS (
  SELECT experiment_id, k_days,
         max(mean) FILTER (variant = 'treatment') AS treat_mean, max(mean) FILTER (variant = 'control') AS control_mean
  FROM trend_daily GROUP BY ALL
),
trend_delta AS (
  SELECT *, treat_mean - control_mean AS delta FROM trend_all
  WHERE treat_mean IS NOT NULL AND control_mean IS NOT NULL
),
trend_fit AS (
  SELECT experiment_id, count(*) AS n, regr_slope(delta, k_days) AS slope, regr_intercept(delta, k_days) AS intercept,
         avg(k_days) AS xbar, var_pop(k_days) * count(*) AS sxx
  FROM trend_delta GROUP BY ALL
),
trend_resid AS (
  SELECT d.*, f.n, f.slope, f.intercept, f.xbar, f.sxx, d.delta - f.intercept - f.slope * d.k_days AS e
  FROM trend_delta d JOIN trend_fit f USING (experiment_id)
),
trend_test AS (
  SELECT experiment_id, n AS num_pre_points, slope, sqrt(sum(e * e) / (n - 2) / sxx) AS se
  FROM trend_resid GROUP BY experiment_id, n, slope, sxx
),
trend_slope AS (
  SELECT t.experiment_id, d.distinct_k, num_pre_points, slope, se, slope / se AS z, @P(slope / se)@ AS p_value,
         CASE WHEN @P(slope / se)@ > 0.05 THEN 'PASS' ELSE 'FAIL' END AS verdict
  FROM trend_test t JOIN (SELECT experiment_id, count(DISTINCT k_days) AS distinct_k FROM trend_daily GROUP BY ALL) d
  USING (experiment_id)
),
user_buckets AS (
  SELECT v.experiment_id, 'order_value' AS metric_name, e.variant, v.user_id,
         date_trunc('week', v.ts)::TIMESTAMP AS bucket_ts,
         floor(datediff('day', v.start_ts, date_trunc('week', v.ts)::TIMESTAMP) / 7.0)::INTEGER AS k, avg(v.value) AS y
  FROM order_values v JOIN exposures e USING (experiment_id, user_id)
  WHERE v.ts BETWEEN v.start_ts - INTERVAL 56 DAY AND v.start_ts + INTERVAL 56 DAY
  GROUP BY ALL
),
bucket_cells AS (
  SELECT experiment_id, metric_name, variant, bucket_ts, k, count(*) AS n_users, avg(y) AS mean_y,
         stddev_samp(y) AS std_y, stddev_samp(y) / sqrt(count(*)) AS se_mean
  FROM user_buckets GROUP BY ALL
),
bucket_delta AS (
  SELECT c.experiment_id, c.metric_name, 'week' AS grain, c.bucket_ts, c.k, t.mean_y - c.mean_y AS delta
  FROM bucket_cells c JOIN bucket_cells t USING (experiment_id, metric_name, bucket_ts, k)
  WHERE c.variant = 'control' AND t.variant = 'treatment'
),
study_rows AS (
  SELECT u.* FROM user_buckets u JOIN bucket_delta d USING (experiment_id, metric_name, bucket_ts, k)
),
study_resid AS (
  SELECT *, y - avg(y) OVER cell AS e, count(*) OVER cell AS n_cell,
         count(*) OVER (PARTITION BY experiment_id) AS n_all
  FROM study_rows WINDOW cell AS (PARTITION BY experiment_id, variant, k)
),
study_var AS (
  SELECT experiment_id, k, any_value(n_all) AS n_all, sum(e * e / n_cell / n_cell) AS v FROM study_resid GROUP BY ALL
),
study AS (
  SELECT d.experiment_id, d.metric_name, 'week' AS grain, d.k, d.delta - r.delta AS beta,
         sqrt((v.v + rv.v) * v.n_all / (v.n_all - 2 * (SELECT count(*) FROM bucket_delta b WHERE b.experiment_id = d.experiment_id))) AS se
  FROM bucket_delta d
  JOIN bucket_delta r ON r.experiment_id = d.experiment_id AND r.k = -1
  JOIN study_var v ON v.experiment_id = d.experiment_id AND v.k = d.k
  JOIN study_var rv ON rv.experiment_id = d.experiment_id AND rv.k = -1
  WHERE d.k <> -1
),
event_study AS (
  SELECT *, @P(beta / nullif(se, 0))@ AS p_value, beta - 1.96 * se AS ci_low, beta + 1.96 * se AS ci_high, -1 AS ref_k
  FROM study
)
"""


def tail(z: str) -> str:
    """Two-sided normal p-value of a z expression: Hart's approximation as given by West."""
    x = f"abs({z})"
    numerator = (
        f"((((((0.0352624965998911 * {x} + 0.700383064443688) * {x} + 6.37396220353165) * {x}"
        f" + 33.912866078383) * {x} + 112.079291497871) * {x} + 221.213596169931) * {x} + 220.206867912376)"
    )
    denominator = (
        f"(((((((0.0883883476483184 * {x} + 1.75566716318264) * {x} + 16.064177579207) * {x}"
        f" + 86.7807322029461) * {x} + 296.564248779674) * {x} + 637.333633378831) * {x}"
        f" + 793.826512519948) * {x} + 440.413735824752)"
    )
    far = f"({x} + 1.0 / ({x} + 2.0 / ({x} + 3.0 / ({x} + 4.0 / ({x} + 0.65)))))"
    return (
        f"(2 * CASE WHEN {x} < 7.07106781186547 THEN exp(-{x} * {x} / 2) * {numerator} / {denominator}"
        f" ELSE exp(-{x} * {x} / 2) / {far} / 2.506628274631 END)"
    )


def expand(sql: str) -> str:
    """Replace each ``@P(expression)@`` by the tail of that expression."""
    while "@P(" in sql:
        start = sql.index("@P(")
        end = sql.index(")@", start)
        sql = sql[:start] + tail(f"({sql[start + 3:end]})") + sql[end + 2:]
    return sql


def statement(body: str, rounding: dict[str, int]) -> str:
    """Full statement: shared CTEs, the body, and the rounding both engines apply."""
    replaced = ", ".join(f"round({c}, {d}) + 0.0 AS {c}" for c, d in rounding.items())
    star = f"* REPLACE ({replaced})" if replaced else "*"
    return expand(f"{BASE}SELECT {star} FROM ({body}) AS answer")
