"""Registered queries: win rates and Bayesian validation.

Outcomes come from `picks_v` (labelled documents: rule = source, won =
quality) and, for the season-drift check, from graded games.  The DuckDB
oracles recompute the Beta quantiles / tail probabilities by fine-grid
integration (lgamma density, trapezoid CDF, linear interpolation), an
independent method from the Spark side's continued-fraction UDF; results
are compared at 4 decimals.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import stats as ST
from ..operators.aggregates import win_rate
from ..sources.fixtures import games_v, picks_v, with_views
from .registry import alias, register

BE = ST.BREAKEVEN
PA = BE * ST.PRIOR_STRENGTH
PB = (1 - BE) * ST.PRIOR_STRENGTH
XS = (BE, 0.55, 0.597, 0.60, 0.65)


def _d(x: float) -> str:
    """A float literal DuckDB reads as DOUBLE (not DECIMAL)."""
    return f"CAST({x!r} AS DOUBLE)"


def _p(sql):
    return with_views(sql, "picks_v")


COUNTS_SQL = "counts AS (SELECT rule, CAST(SUM(won) AS BIGINT) AS wins, COUNT(*) AS n FROM picks_v GROUP BY rule)"
POST_SQL = f"""post AS (SELECT rule, wins, n, {_d(PA)} + wins AS alpha, {_d(PB)} + (n - wins) AS beta,
  ({_d(PA)} + wins) / ({_d(PA)} + wins + {_d(PB)} + (n - wins)) AS posterior_mean FROM counts)"""

# Density on K + 1 points over twelve deviations each way, normalised by its own integral; the running
# trapezoid sum is corrected by the slope (Euler-Maclaurin), so K = 4000 gives far more than four decimals.
K = 4000
GRID_SQL = f"""shape AS (SELECT rule, alpha, beta, posterior_mean AS m, sqrt(posterior_mean * (1 - posterior_mean) / (alpha + beta + 1)) AS sd
  FROM post),
points AS (SELECT rule, alpha, beta, k, greatest(1e-9, m - 12 * sd) AS lo, least(1 - 1e-9, m + 12 * sd) AS hi, m
  FROM shape, range(0, {K + 1}) AS t(k)),
dens AS (SELECT *, (hi - lo) / {K} AS h, lo + k * (hi - lo) / {K} AS x,
    exp((alpha - 1) * ln((lo + k * (hi - lo) / {K}) / m) + (beta - 1) * ln((1 - (lo + k * (hi - lo) / {K})) / (1 - m))) AS f
  FROM points),
sloped AS (SELECT *, f * ((alpha - 1) / x - (beta - 1) / (1 - x)) AS s FROM dens),
raw AS (SELECT rule, k, x, h, f, s, h * (sum(f) OVER w - f / 2 - first_value(f) OVER w / 2)
    - h * h / 12 * (s - first_value(s) OVER w) AS c
  FROM sloped WINDOW w AS (PARTITION BY rule ORDER BY k)),
cdf AS (SELECT rule, x, f / t AS f, s / t AS s, c / t AS c FROM raw JOIN (SELECT rule, max(c) AS t FROM raw GROUP BY rule) USING (rule))"""


def _quantile_sql(q):
    """From the last grid point below the quantile, the root of the second-order expansion of the CDF."""
    gap = f"({_d(q)} - c)"
    return (f"(SELECT arg_max(x + 2 * {gap} / (f + sqrt(f * f + 2 * s * {gap})), x) FROM cdf "
            f"WHERE cdf.rule = post.rule AND c <= {_d(q)})")


@register("agg_win_rate", _p("""
SELECT rule, CAST(SUM(won) AS BIGINT) AS wins, COUNT(*) AS n, SUM(won) / COUNT(*) AS rate FROM picks_v GROUP BY rule
UNION ALL SELECT 'ALL', CAST(SUM(won) AS BIGINT), COUNT(*), SUM(won) / COUNT(*) FROM picks_v"""))
def q_win_rate(spark, sf):
    return win_rate(picks_v(spark, sf))


def _post(spark, sf):
    return ST.beta_posterior(ST.win_counts(picks_v(spark, sf)))


@register("stat_beta_posterior", _p(f"WITH {COUNTS_SQL}, {POST_SQL}\nSELECT * FROM post"))
def q_posterior(spark, sf):
    return _post(spark, sf)


@register("stat_win_rate_by_rule", _p(f"""WITH {COUNTS_SQL}, {POST_SQL}
SELECT rule, wins, n, ROUND(wins / n, 6) AS raw_rate, ROUND(posterior_mean, 6) AS shrunk_rate FROM post"""))
def q_rates(spark, sf):
    return ST.rates(_post(spark, sf))


STEP = (0.72 - 0.45) / 499


@register("stat_beta_density", _p(f"""WITH {COUNTS_SQL}, {POST_SQL}
SELECT rule, CAST(i AS INTEGER) AS i, ROUND({_d(0.45)} + i * {_d(STEP)}, 10) AS x,
  ROUND(exp(lgamma(alpha + beta) - lgamma(alpha) - lgamma(beta) + (alpha - 1) * ln({_d(0.45)} + i * {_d(STEP)})
            + (beta - 1) * ln(1 - ({_d(0.45)} + i * {_d(STEP)}))), 6) AS density
FROM post, range(0, 500) t(i)"""))
def q_density(spark, sf):
    return ST.beta_density(_post(spark, sf))


CI_SQL = _p(f"""WITH {COUNTS_SQL}, {POST_SQL}, {GRID_SQL}
SELECT rule, wins, n, alpha, beta, posterior_mean,
  ROUND({_quantile_sql(0.025)}, 4) AS lo_95, ROUND({_quantile_sql(0.975)}, 4) AS hi_95,
  ROUND({_quantile_sql(0.125)}, 4) AS lo_75, ROUND({_quantile_sql(0.875)}, 4) AS hi_75
FROM post""")


@register("stat_credible_interval", CI_SQL)
def q_ci(spark, sf):
    return ST.credible_interval(_post(spark, sf))


alias("udaf_beta_interval", "stat_credible_interval")


S = 1000
# Simpson's rule from the point to twelve deviations above the mean, over the same from below.
@register("stat_prob_at_least", _p(f"""WITH {COUNTS_SQL}, {POST_SQL},
shape AS (SELECT rule, alpha, beta, posterior_mean AS m, sqrt(posterior_mean * (1 - posterior_mean) / (alpha + beta + 1)) AS sd
  FROM post),
spans AS (SELECT rule, x, alpha, beta, m, x AS a, greatest(x, least(1 - 1e-12, m + 12 * sd)) AS b, 1 AS upper
  FROM shape, (VALUES {', '.join(f'({_d(x)})' for x in XS)}) v(x)
  UNION ALL SELECT rule, x, alpha, beta, m, least(x, greatest(1e-12, m - 12 * sd)), x, 0
  FROM shape, (VALUES {', '.join(f'({_d(x)})' for x in XS)}) v(x)),
nodes AS (SELECT *, a + i * (b - a) / {S} AS t, (b - a) / {S} / 3 * CASE WHEN i IN (0, {S}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
  FROM spans, range(0, {S + 1}) AS r(i)),
parts AS (SELECT rule, x, upper, sum(w * exp((alpha - 1) * ln(t / m) + (beta - 1) * ln((1 - t) / (1 - m)))) AS p
  FROM nodes GROUP BY ALL)
SELECT rule, x, round(sum(p) FILTER (upper = 1) / sum(p), 4) AS p_at_least FROM parts GROUP BY rule, x"""))
def q_prob(spark, sf):
    return ST.prob_at_least(_post(spark, sf), XS)


@register("stat_ev", _p(f"""WITH {COUNTS_SQL}
SELECT rule, wins, n, ROUND(wins / n, 6) AS rate, {_d(round(BE, 12))} AS breakeven, wins / n > {BE!r} AS beats_breakeven,
  ROUND(wins / n * {100 / 110!r} - (1 - wins / n), 6) AS ev_per_unit FROM counts"""))
def q_ev(spark, sf):
    return ST.ev(ST.win_counts(picks_v(spark, sf)))


@register("fn_logit", _p(f"""WITH {COUNTS_SQL}
SELECT rule, ROUND(CASE WHEN wins > 0 AND wins < n THEN ln((wins / n) / (1 - wins / n)) END, 9) AS logit_rate,
  ROUND(CASE WHEN wins > 0 AND wins < n THEN 1 / (1 + exp(-ln((wins / n) / (1 - wins / n)))) END, 9) AS expit_logit
FROM counts"""))
def q_logit(spark, sf):
    return ST.logit_rates(ST.win_counts(picks_v(spark, sf)))


def season_cover_rates(games):
    """Home cover (compat test, J9) rate per season over played, quoted games."""
    g = games.filter(F.col("home_points").isNotNull() & F.col("mode_spread").isNotNull())
    cov = (F.col("home_points") - F.col("away_points")) > F.col("mode_spread")
    return g.groupBy("season").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(cov, 1)).alias("wins")) \
            .withColumn("rate", F.col("wins") / F.col("n"))


@register("stat_season_drift", with_views("""
WITH s AS (SELECT season, COUNT(*) AS n,
             COUNT(CASE WHEN (home_points - away_points) > mode_spread THEN 1 END) AS wins
           FROM games_v WHERE home_points IS NOT NULL AND mode_spread IS NOT NULL GROUP BY season),
r AS (SELECT *, wins / n AS rate FROM s)
SELECT season, n, wins, rate, LEAD(rate) OVER (ORDER BY season) AS next_rate,
  COALESCE(rate > 0.55 AND LEAD(rate) OVER (ORDER BY season) < 0.5, FALSE) AS drift_flag FROM r""", "games_v"))
def q_drift(spark, sf):
    return ST.season_drift(season_cover_rates(games_v(spark, sf)))


# ---------------------------------------------------------------- M6 / M7

# The model on one fixed product grid of (mu, sigma, z), fine enough for the test tables' group sizes; half-normal
# sigma on midpoints, which the even integrand makes as good as a full line.
MU0 = math.log(BE / (1 - BE))
NZ, SPAN = 96, 6.5


def _pool_sql(NU, NV):
    return f"""grid AS (
  SELECT (iu + 0.5) * {2 * SPAN / NU!r} - {SPAN} AS u, (iv + 0.5) * {SPAN / NV!r} AS v FROM range(0, {NU}) a(iu), range(0, {NV}) b(iv)),
effects AS (SELECT (iz + 0.5) * {2 * 8.0 / NZ!r} - 8.0 AS z FROM range(0, {NZ}) c(iz)),
rates AS (SELECT u, v, z, 1 / (1 + exp(-({MU0!r} + 0.3 * u + 0.4 * v * z))) AS th FROM grid, effects),
given AS (
  SELECT rule, u, v, sum(e) AS l, sum(e * th) / sum(e) AS t FROM (
    SELECT rule, u, v, th, exp(wins * ln(th * n / wins) + if(wins < n, (n - wins) * ln((1 - th) * n / (n - wins)), 0) - z * z / 2) AS e
    FROM rates, counts WHERE wins > 0
    UNION ALL SELECT rule, u, v, th, exp(n * ln(1 - th) - z * z / 2) FROM rates, counts WHERE wins = 0)
  GROUP BY rule, u, v),
joint AS (SELECT u, v, sum(ln(l)) - (u * u + v * v) / 2 AS lp FROM given GROUP BY u, v),
post2 AS (SELECT u, v, exp(lp - max(lp) OVER ()) AS w FROM joint),
-- the mean of sigma is the one integrand that is not even: the midpoint sum's end correction at sigma = 0
spread AS (
  SELECT 0.4 * (sum(w * v) - {SPAN / NV!r} / 24 * (9 * sum(w) FILTER (v < {SPAN / NV!r})
    - sum(w) FILTER (v BETWEEN {SPAN / NV!r} AND {2 * SPAN / NV!r})) / 8) / sum(w) AS sigma FROM post2)"""


POOL_SQL = _pool_sql(48, 40)


@register("stat_partial_pooling", _p(f"""WITH {COUNTS_SQL}, {POOL_SQL}
SELECT rule, any_value(wins) AS wins, any_value(n) AS n, round(sum(w * t) / sum(w), 4) AS theta_mean,
  round(sum(w * ({MU0!r} + 0.3 * u)) / sum(w), 4) AS mu_mean, any_value(round(sigma, 4)) AS sigma_mean
FROM given JOIN post2 USING (u, v) JOIN counts USING (rule), spread GROUP BY rule"""))
def q_pool(spark, sf):
    return ST.partial_pooling(ST.win_counts(picks_v(spark, sf)), digits=4)


# The marginal density on K points of nine deviations each way: for every point left of the peak the point of equal
# density on the right (the nearest from above, then linear), and the mass between them.  The density needs a finer
# grid of mu than the means do, as near sigma = 0 it is a sum of narrow peaks.
HK = 2000
HDI_SQL = f"""mids AS (
  SELECT rule, wins, n, sum(w * t) / sum(w) AS m, sqrt(sum(w * t) / sum(w) * (1 - sum(w * t) / sum(w)) / n) AS sd
  FROM given JOIN post2 USING (u, v) JOIN counts USING (rule) GROUP BY rule, wins, n),
ends AS (SELECT rule, wins, n, greatest(1e-9, m - 9 * sd) AS lo, least(1 - 1e-9, m + 9 * sd) AS hi FROM mids),
at_ AS (SELECT rule, wins, n, k, (hi - lo) / {HK} AS h, lo + k * (hi - lo) / {HK} AS th FROM ends, range(0, {HK + 1}) AS r(k)),
own AS (SELECT rule, {MU0!r} + 0.3 * u AS mu, 0.4 * v AS s, w / l / v AS w FROM given JOIN post2 USING (u, v) WHERE w > 1e-8),
f0 AS (
  SELECT rule, k, h, th, sum(w * exp(-power((ln(th / (1 - th)) - mu) / s, 2) / 2)) / (th * (1 - th)) * exp(
    if(wins > 0, wins * ln(th * n / greatest(wins, 1)), 0) + if(wins < n, (n - wins) * ln((1 - th) * n / greatest(n - wins, 1)), 0)) AS f
  FROM at_ JOIN own USING (rule) GROUP BY rule, k, h, th, wins, n),
f1 AS (SELECT *, h * (sum(f) OVER q - f / 2 - first_value(f) OVER q / 2) AS c, lead(f) OVER q AS nf,
    sum(f) OVER (PARTITION BY rule) * h AS total, arg_max(th, f) OVER (PARTITION BY rule) AS peak
  FROM f0 WINDOW q AS (PARTITION BY rule ORDER BY k)),
sides AS (
  SELECT l.rule, l.k, l.h, l.th AS a, r.th + (r.f - l.f) / (r.f - r.nf) * r.h AS b,
    (r.c + (r.f - l.f) / (r.f - r.nf) * r.h * (r.f + l.f) / 2 - l.c) / l.total AS mass
  FROM (SELECT * FROM f1 WHERE th < peak) AS l ASOF JOIN (SELECT * FROM f1 WHERE th >= peak AND nf < f) AS r
    ON l.rule = r.rule AND l.f <= r.f),
steps AS (SELECT *, lead(a) OVER q AS a2, lead(b) OVER q AS b2, lead(mass) OVER q AS mass2 FROM sides
  WINDOW q AS (PARTITION BY rule ORDER BY k))"""


@register("stat_hdi", _p(f"""WITH {COUNTS_SQL}, {_pool_sql(160, 64)}, {HDI_SQL}
SELECT rule, round(a + (mass - 0.94) / (mass - mass2) * (a2 - a), 4) AS hdi_lo,
  round(b + (mass - 0.94) / (mass - mass2) * (b2 - b), 4) AS hdi_hi
FROM steps WHERE mass >= 0.94 AND mass2 < 0.94"""))
def q_hdi(spark, sf):
    return ST.hdi(ST.win_counts(picks_v(spark, sf)), digits=4)
