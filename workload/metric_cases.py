"""Filters, joins, aggregates, distributions and data quality (survey 2.2 - 2.4, 2.7, 2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from armlift.functions.scalars import bucket_start, event_time_k as event_k
from armlift.operators import ab, event_study, grain, metrics, pretrend, profile, quality, rollup, sketches, windows
from armlift.operators.exposure import assign_variants, dedup_exposures
from armlift.plans import late
from armlift.sources import tables
from armlift.sources.readers import align_outcomes
from workload import fixtures as fx
from workload.case import case

# Days by which the analysis window ends before the last outcome.
CUT = 90
CUT_SQL = """
  (SELECT o.* FROM joined o JOIN registry r USING (experiment_id)
   WHERE metric_name = 'pre_revenue' OR o.ts BETWEEN r.start_ts AND r.end_ts - INTERVAL 90 DAY)
"""


@case(
    """
    SELECT o.experiment_id, o.metric_name, count(*) AS rows, sum(value) AS total, min(ts) AS first_ts, max(ts) AS last_ts
    FROM outcomes o JOIN registry r USING (experiment_id)
    WHERE metric_name = 'pre_revenue' OR o.ts BETWEEN r.start_ts AND r.end_ts - INTERVAL 90 DAY
    GROUP BY ALL
    """,
    digits="total:5",
)
def window_filter(spark, sf):
    kept = windows.window_filter(fx.outcomes(spark, sf), fx.registry(spark, CUT))
    return kept.groupBy("experiment_id", "metric_name").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("value").alias("total"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


@case(
    """
    SELECT experiment_id, start_ts, end_ts, 'REGISTRY' AS window_status FROM registry WHERE experiment_id = 'exp_orders_a'
    UNION ALL
    SELECT experiment_id, min(exposure_ts), max(exposure_ts), 'EXPOSURES' FROM exposures
    WHERE experiment_id = 'exp_orders_b' GROUP BY ALL
    UNION ALL SELECT 'exp_unseen', NULL, NULL, 'NO_WINDOW'
    """
)
def window_from_registry(spark, sf):
    """One experiment open in the registry, with its exposures as window, and one nobody was exposed to."""
    half_open = fx.registry(spark).withColumn(
        "end_ts", F.when(F.col("experiment_id") == "exp_orders_a", F.col("end_ts"))
    )
    unseen = half_open.limit(1).withColumn("experiment_id", F.lit("exp_unseen")).withColumn(
        "end_ts", F.lit(None).cast("timestamp")
    )
    return windows.window_from_registry(half_open.unionByName(unseen), fx.exposures(spark, sf))


@case(
    """
    SELECT experiment_id, count(*) AS rows, count(DISTINCT user_id) AS users, min(ts) AS first_ts, max(ts) AS last_ts
    FROM order_values WHERE ts BETWEEN start_ts - INTERVAL 28 DAY AND start_ts + INTERVAL 28 DAY GROUP BY ALL
    """
)
def event_window(spark, sf):
    scoped = windows.event_window(fx.order_values(spark, sf), fx.registry(spark), "day", 28, 28)
    return scoped.groupBy("experiment_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("user_id").alias("users"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


@case(
    """
    SELECT o.experiment_id, e.variant, count(*) AS rows, count(DISTINCT o.user_id) AS users, sum(value) AS total
    FROM order_values o LEFT JOIN exposures e USING (experiment_id, user_id) GROUP BY ALL
    """,
    digits="total:5",
)
def join_left_exposed(spark, sf):
    joined = grain.join_left_exposed(fx.order_values(spark, sf), fx.exposures(spark, sf))
    return joined.groupBy("experiment_id", "variant").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("user_id").alias("users"),
        F.sum("value").alias("total"),
    )


@case("SELECT experiment_id, user_id, metric_name, value, ts, variant FROM joined", digits="value")
def join_inner_exposed(spark, sf):
    return grain.join_inner_exposed(fx.outcomes(spark, sf), fx.exposures(spark, sf))


_RANKED = """
  (SELECT experiment_id, metric_name, {extra} value, n, row_number() OVER (PARTITION BY experiment_id, metric_name {part} ORDER BY value) AS rank
   FROM (SELECT *, count(*) OVER (PARTITION BY experiment_id, metric_name {part}) AS n FROM {source}))
"""


def _at_percents(source: str, extra: str = "", part: str = "") -> str:
    ranked = _RANKED.format(source=source, extra=extra, part=part)
    return f"""
      SELECT experiment_id, metric_name, {extra} q::INTEGER AS q, value
      FROM {ranked} CROSS JOIN range(1, 100) AS p(q)
      WHERE rank = greatest(ceil(q::DOUBLE / 100 * n), 1)
    """


@case(
    f"""
    SELECT experiment_id, q, a.value AS pre_revenue_value, b.value AS revenue_value
    FROM ({_at_percents("outcomes")}) a JOIN ({_at_percents("outcomes")}) b USING (experiment_id, q)
    WHERE a.metric_name = 'pre_revenue' AND b.metric_name = 'revenue'
    """,
    digits="pre_revenue_value revenue_value",
)
def quantile_join(spark, sf):
    return profile.quantile_join(fx.outcomes(spark, sf))


@case(
    _at_percents(
        """(SELECT *, CASE WHEN (('0x' || substr(md5('exp_events:' || user_id), 1, 8))::BIGINT // 100) % 100 < 50
                      THEN 'treatment' ELSE 'control' END AS variant FROM event_outcomes WHERE value <> 0)""",
        extra="variant,",
        part=", variant",
    ),
    digits="value",
)
def quantiles(spark, sf):
    """Non-zero event values per event type and arm."""
    events = assign_variants(fx.event_outcomes(spark, sf).where("value <> 0"), exposure_rate=1.0)
    return profile.quantiles(events, ["experiment_id", "metric_name", "variant"])


@case(
    f"""
    SELECT experiment_id, variant, metric_name, count(*) AS n, avg(value) AS mean, sum(value) AS sum,
           stddev_samp(value) AS stddev, min(value) AS min, max(value) AS max
    FROM {CUT_SQL} GROUP BY ALL
    """,
    digits="mean sum:5 stddev min max",
)
def metric_overall(spark, sf):
    return metrics.metric_overall(
        fx.outcomes(spark, sf), fx.exposures_logged(spark, sf), fx.registry(spark, CUT)
    )


_DAILY_SQL = f"""
    SELECT experiment_id, variant, metric_name, ts::DATE AS day, count(*) AS n, avg(value) AS mean, sum(value) AS sum
    FROM {CUT_SQL} GROUP BY ALL
"""


@case(_DAILY_SQL, digits="mean:10 sum:6")
def metric_daily(spark, sf):
    return metrics.metric_daily(
        fx.outcomes(spark, sf), fx.exposures_logged(spark, sf), fx.registry(spark, CUT)
    )


@case(
    f"SELECT * FROM ({_DAILY_SQL}) ORDER BY experiment_id, day NULLS FIRST, metric_name, variant LIMIT 10",
    digits="mean:10 sum:6",
)
def daily_preview(spark, sf):
    return metrics.daily_preview(
        metrics.metric_daily(
            fx.outcomes(spark, sf), fx.exposures_logged(spark, sf), fx.registry(spark, CUT)
        )
    )


@case(
    """
    SELECT experiment_id, metric_name, variant, count(*) AS n, avg(value) AS mean,
           var_samp(value) AS var, stddev_samp(value) AS std
    FROM joined GROUP BY ALL
    """,
    digits="mean var:3 std",
)
def ab_stats(spark, sf):
    return ab.ab_stats(fx.outcomes(spark, sf), fx.exposures_logged(spark, sf))


@case(
    """
    SELECT experiment_id, user_id, variant,
           (min({'t': coalesce(ts, TIMESTAMP '9999-12-31'), 'v': value}) FILTER (metric_name = 'revenue')).v AS y,
           (min({'t': coalesce(ts, TIMESTAMP '9999-12-31'), 'v': value}) FILTER (metric_name = 'pre_revenue')).v AS x
    FROM joined GROUP BY ALL HAVING y IS NOT NULL AND x IS NOT NULL
    """,
    digits="x y",
)
def user_pivot(spark, sf):
    return grain.user_pivot(fx.outcomes(spark, sf), fx.exposures_logged(spark, sf))


@case(
    """
    SELECT experiment_id, user_id, variant,
           max(CASE WHEN metric_name = 'revenue' THEN value ELSE 0 END) AS y,
           max(CASE WHEN metric_name = 'pre_revenue' THEN value ELSE 0 END) AS x
    FROM joined WHERE metric_name IN ('revenue', 'pre_revenue') GROUP BY ALL
    """,
    digits="x y",
)
def user_pivot_zero(spark, sf):
    return grain.user_pivot_zero(fx.outcomes(spark, sf), fx.exposures_logged(spark, sf))


@case(
    """
    SELECT experiment_id, user_id, metric_name, sum(value) AS value, avg(value) AS mean_value,
           max(value) AS max_value, min({'t': coalesce(ts, TIMESTAMP '9999-12-31'), 'v': value}).v AS first_value
    FROM outcomes GROUP BY ALL
    """,
    digits="value mean_value:10 max_value first_value",
)
def user_rollup(spark, sf):
    outcomes = fx.outcomes(spark, sf)
    forms = {"sum": "value", "mean": "mean_value", "max": "max_value", "first": "first_value"}
    return grain.user_rollup(outcomes, forms)


@case("SELECT experiment_id, k_days, variant, mean FROM trend_daily", digits="mean:10")
def pretrend_daily(spark, sf):
    return pretrend.pretrend_daily(fx.outcomes(spark, sf), fx.exposures_logged(spark, sf))


@case(
    "SELECT experiment_id, k_days, treat_mean, control_mean, delta FROM trend_delta",
    digits="treat_mean:10 control_mean:10 delta:10",
)
def pretrend_delta(spark, sf):
    return pretrend.pretrend_delta(pretrend_daily(spark, sf))


@case(
    """
    SELECT experiment_id, count(*) AS distinct_k, count(delta) AS n,
           avg(k_days) FILTER (delta IS NOT NULL) AS xbar, avg(delta) AS ybar,
           regr_sxx(delta, k_days) AS s_xx, regr_sxy(delta, k_days) AS s_xy, regr_syy(delta, k_days) AS s_yy
    FROM (SELECT *, treat_mean - control_mean AS delta FROM trend_all) GROUP BY ALL
    """,
    digits="xbar ybar s_xx:3 s_xy:4 s_yy:4",
)
def pretrend_moments(spark, sf):
    return pretrend.pretrend_moments(pretrend_daily(spark, sf))


def user_buckets(spark, sf):
    return event_study.user_bucket_mean(
        fx.order_values(spark, sf), fx.exposures_logged(spark, sf), fx.registry(spark),
        "order_value", "week", 8, 8,
    )


@case("SELECT * FROM user_buckets", digits="y:10")
def user_bucket_mean(spark, sf):
    return user_buckets(spark, sf)


@case("SELECT * FROM bucket_cells", digits="mean_y:9 std_y:9 se_mean:9")
def bucket_cells(spark, sf):
    return event_study.bucket_cells(user_buckets(spark, sf))


@case("SELECT * FROM bucket_delta", digits="delta:10")
def bucket_delta(spark, sf):
    return event_study.bucket_delta(event_study.bucket_cells(user_buckets(spark, sf)), "week")


@case(
    """
    SELECT experiment_id, grain, k, count(*) AS rows
    FROM (SELECT o.experiment_id, 'day' AS grain, datediff('day', r.start_ts, o.ts)::INTEGER AS k
          FROM outcomes o JOIN registry r USING (experiment_id)
          UNION ALL
          SELECT o.experiment_id, 'week', floor(datediff('day', r.start_ts, date_trunc('week', o.ts)::TIMESTAMP) / 7.0)::INTEGER
          FROM outcomes o JOIN registry r USING (experiment_id))
    GROUP BY ALL
    """
)
def event_time_k(spark, sf):
    """Outcome rows per bucket relative to the start, by day and by week."""
    dated = windows.lookup(
        fx.outcomes(spark, sf), fx.registry(spark).select("experiment_id", "start_ts")
    )
    bucketed = [
        F.struct(
            F.lit(g).alias("grain"),
            event_k(bucket_start(F.col("ts"), g), F.col("start_ts"), g).alias("k"),
        )
        for g in ("day", "week")
    ]
    return (
        dated.select("experiment_id", F.inline(F.array(*bucketed)))
        .groupBy("experiment_id", "grain", "k")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@case(
    """
    SELECT experiment_id, unnest(['exposures_rows', 'exposures_null_user_id', 'min_exposure_ts', 'max_exposure_ts']) AS check_name,
           unnest([count(*)::VARCHAR, (count(*) - count(user_id))::VARCHAR,
                   strftime(min(exposure_ts), '%Y-%m-%d %H:%M:%S'), strftime(max(exposure_ts), '%Y-%m-%d %H:%M:%S')]) AS value
    FROM exposures_raw GROUP BY experiment_id
    UNION ALL
    SELECT experiment_id, unnest(['outcomes_rows', 'outcomes_null_user_id']), unnest([count(*)::VARCHAR, '0'])
    FROM outcomes GROUP BY experiment_id
    UNION ALL
    SELECT experiment_id, 'registry_rows', count(*)::VARCHAR FROM registry GROUP BY experiment_id
    """
)
def dq_summary(spark, sf):
    return quality.dq_summary(
        fx.exposures_logged(spark, sf),
        fx.outcomes(spark, sf),
        fx.registry(spark),
    )


@case("SELECT experiment_id, variant, count(*) AS rows FROM exposures_raw GROUP BY ALL")
def dq_variant_dist(spark, sf):
    return quality.dq_variant_dist(fx.exposures_logged(spark, sf))


@case(
    """
    SELECT experiment_id, metric_name, count(*) AS rows
    FROM (SELECT experiment_id, metric_name FROM outcomes UNION ALL SELECT experiment_id, metric_name FROM event_outcomes)
    GROUP BY ALL
    """
)
def dq_metric_dist(spark, sf):
    return quality.dq_metric_dist(
        fx.outcomes(spark, sf).unionByName(fx.event_outcomes(spark, sf))
    )


@case(
    """
    SELECT experiment_id, user_id, metric_name, count(*) AS rows FROM outcomes
    GROUP BY ALL HAVING count(*) > 1
    """
)
def dq_duplicates(spark, sf):
    return quality.dq_duplicates(
        fx.outcomes(spark, sf), ["experiment_id", "user_id", "metric_name"]
    )


@case(
    """
    SELECT experiment_id, metric_name, count(*) AS rows,
           count(*) FILTER (metric_name = 'order_value' AND ts < exposure_ts) AS post_before_exposure,
           count(*) FILTER (metric_name LIKE 'pre\\_%' ESCAPE '\\' AND ts >= exposure_ts) AS pre_after_exposure,
           count(*) FILTER (metric_name = 'order_value' AND NOT ts BETWEEN start_ts AND end_ts - INTERVAL 90 DAY) AS post_outside_window,
           0::BIGINT AS undated
    FROM (SELECT experiment_id, user_id, metric_name, value, ts FROM order_values
          UNION ALL SELECT experiment_id, user_id, 'pre_order_value', value, ts FROM order_values)
    JOIN exposures USING (experiment_id, user_id) JOIN registry USING (experiment_id)
    GROUP BY ALL
    """
)
def dq_leakage(spark, sf):
    """Every order under a post and a pre name, so each kind of leak occurs."""
    names = F.explode(F.array(F.lit("order_value"), F.lit("pre_order_value")))
    both = fx.order_values(spark, sf).withColumn("metric_name", names)
    return quality.dq_leakage(both, fx.exposures(spark, sf), fx.registry(spark, CUT))


@case(
    """
    SELECT experiment_id, r.n AS raw_rows, c.n AS canonical_rows, r.n - c.n AS dropped_rows
    FROM (SELECT experiment_id, count(*) AS n FROM exposures_raw GROUP BY ALL) r
    JOIN (SELECT experiment_id, count(*) AS n FROM exposures GROUP BY ALL) c USING (experiment_id)
    """
)
def dq_rowcount_delta(spark, sf):
    raw = fx.exposures_logged(spark, sf)
    return quality.dq_rowcount_delta(raw, dedup_exposures(raw))


@case(
    """
    SELECT experiment_id, 'variant ' || variant AS grouping, count(*) AS rows, count(DISTINCT user_id) AS users
    FROM exposures_raw GROUP BY ALL
    UNION ALL
    SELECT experiment_id, 'metric ' || metric_name, count(*), count(DISTINCT user_id) FROM outcomes GROUP BY ALL
    UNION ALL
    SELECT experiment_id, 'all', count(*), count(DISTINCT user_id) FROM event_outcomes GROUP BY ALL
    """
)
def distinct_users(spark, sf):
    label = lambda prefix, c: F.concat(F.lit(prefix), F.col(c))
    exposures = fx.exposures_logged(spark, sf)
    parts = [
        exposures.withColumn("grouping", label("variant ", "variant")),
        fx.outcomes(spark, sf).withColumn("grouping", label("metric ", "metric_name")),
        fx.event_outcomes(spark, sf).withColumn("grouping", F.lit("all")),
    ]
    columns = ["experiment_id", "grouping", "user_id"]
    rows = parts[0].select(columns).unionByName(parts[1].select(columns)).unionByName(parts[2].select(columns))
    return profile.distinct_users(rows, ["experiment_id", "grouping"])


@case("SELECT experiment_id, metric_name, count(DISTINCT ts::DATE) AS days FROM event_outcomes GROUP BY ALL")
def distinct_days(spark, sf):
    return profile.distinct_days(fx.event_outcomes(spark, sf))


@case(
    """
    SELECT experiment_id, variant, metric_name, count(DISTINCT user_id) AS total_users,
           count(DISTINCT CASE WHEN value <> 0 THEN user_id END) AS converted_users, count(*) AS rows,
           count(DISTINCT CASE WHEN value <> 0 THEN user_id END) / count(DISTINCT user_id) AS conversion_proportion
    FROM joined WHERE metric_name = 'conversion' GROUP BY ALL
    """,
    digits="conversion_proportion",
)
def converted_users(spark, sf):
    conversions = fx.outcomes(spark, sf).where("metric_name = 'conversion'")
    return ab.converted_users(grain.join_inner_exposed(conversions, fx.exposures(spark, sf)))


@case(
    "SELECT experiment_id, metric_name, round(value, 0) AS rounded_value, count(*) AS rows FROM outcomes GROUP BY ALL",
    digits="rounded_value:0",
)
def value_histogram(spark, sf):
    return profile.value_histogram(fx.outcomes(spark, sf))


@case("SELECT DISTINCT experiment_id, metric_name, user_id FROM outcomes")
def distinct_rows(spark, sf):
    return profile.distinct_rows(
        fx.outcomes(spark, sf), ["experiment_id", "metric_name", "user_id"]
    )


@case(
    """
    SELECT experiment_id, metric_name, date_trunc('month', ts)::DATE AS month, count(*) AS rows,
           count(DISTINCT user_id) AS exact_users, TRUE AS within_error
    FROM outcomes WHERE ts IS NOT NULL GROUP BY ALL
    """
)
def users_from_sketches(spark, sf):
    """Monthly users from daily sketches, beside the exact count they have to be within five errors of."""
    outcomes = fx.outcomes(spark, sf).where("ts IS NOT NULL")
    by = ["experiment_id", "metric_name", "month"]
    monthly = sketches.daily_sketches(outcomes).withColumn("month", F.trunc("day", "month"))
    exact = profile.distinct_users(outcomes.withColumn("month", F.trunc("ts", "month")), by)
    found = sketches.united(monthly, by).withColumnRenamed("users", "estimate").join(
        exact.select(*by, F.col("users").alias("exact_users")), by
    )
    close = F.abs(F.col("estimate") - F.col("exact_users")) <= 5 * sketches.error_of() * F.col("exact_users") + 1
    return found.select(*by, "rows", "exact_users", close.alias("within_error"))


@case(
    """
    SELECT experiment_id, variant, metric_name, ts::DATE AS day, count(*) AS n, avg(value) AS mean, sum(value) AS sum
    FROM joined JOIN registry USING (experiment_id)
    WHERE metric_name = 'pre_revenue' OR ts BETWEEN start_ts AND end_ts GROUP BY ALL
    """,
    digits="mean:9 sum:6",
)
def late_daily(spark, sf):
    """Daily metrics after a batch, a late one with wrong values, and the same late one mended."""
    root = tables.new_path(spark, "late_daily")
    exposures, registry = fx.exposures(spark, sf), fx.registry(spark)
    logged = fx.outcomes_raw(spark, sf)
    part = lambda when: align_outcomes(logged.where(when))
    wrong = part("o_orderkey % 10 < 2").withColumn("value", F.col("value") * 2)
    for batch, rows in (("first", part("o_orderkey % 10 > 0")), ("late", wrong), ("late", part("o_orderkey % 10 = 0"))):
        late.absorb(spark, root, batch, rows, exposures, registry, fx.SPECS, span="year")
    return late.daily(spark, root)


@case(
    """
    SELECT experiment_id, user_id, variant, metric_name, ts::DATE AS day, count(*) AS rows, sum(value) AS total,
           max(value) AS highest, coalesce(ts BETWEEN start_ts AND end_ts, FALSE) AS inside
    FROM joined JOIN registry USING (experiment_id) GROUP BY ALL
    """,
    digits="total highest",
)
def user_days(spark, sf):
    """The roll-up that every analysis of the batch follows from."""
    days = rollup.user_days(fx.outcomes(spark, sf), fx.exposures(spark, sf), fx.registry(spark), fx.SPECS, unique=True)
    return days.select("experiment_id", "user_id", "variant", "metric_name", "day", "rows", "total", "highest", "inside")
