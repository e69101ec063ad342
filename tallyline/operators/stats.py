"""Win rates and Bayesian summaries as Spark jobs over
GROUPED outcomes.

The reference runs these on a few hard-coded counts with SciPy and an MCMC
sampler on the driver.  Here the counts come from a `groupBy` over the pick
table, and every posterior quantity is computed on executors:

* conjugate Beta-Binomial (M1-M5, M9): arithmetic on the aggregated rows,
  incomplete-beta pandas UDF (K4) for intervals and tail probabilities;
* partial pooling (M6): deterministic quadrature instead of a sampler.  For
  every group and (mu, sigma) node the group's own effect is integrated by
  adaptive Gauss-Hermite nodes, centred and scaled on its mode and curvature,
  in log space; the log likelihoods are summed per node over all groups.  The
  (mu, sigma) grid is narrowed until it resolves the posterior;
* HDI (M7): the group's marginal density on a grid scaled to its own mean and
  deviation; the interval's ends have equal density.

Work grows with (#groups x nodes), never with per-group input size.  The
driver sees the summed log likelihood of the (mu, sigma) nodes only.
"""

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.beta import beta_cdf, beta_logpdf, beta_ppf
from ..functions.scalar import expit, logit
from ..session import checkpoint_dir

HALF_LN_2PI = 0.5 * math.log(2 * math.pi)
BREAKEVEN = 110.0 / 210.0
PRIOR_STRENGTH = 80.0


def win_counts(picks: DataFrame, by: str = "rule", won: str = "won") -> DataFrame:
    """(group, wins, n) - the aggregated input of every model below."""
    return picks.groupBy(by).agg(F.sum(F.col(won).cast("bigint")).alias("wins"),
                                 F.count(F.lit(1)).alias("n"))


def beta_posterior(counts: DataFrame, p0: float = BREAKEVEN, strength: float = PRIOR_STRENGTH) -> DataFrame:
    """M1: prior Beta(p0*s, (1-p0)*s) + (wins, losses) -> alpha, beta, mean."""
    a = F.lit(p0 * strength) + F.col("wins")
    b = F.lit((1 - p0) * strength) + (F.col("n") - F.col("wins"))
    return counts.withColumns({"alpha": a, "beta": b, "posterior_mean": a / (a + b)})


def beta_density(post: DataFrame, lo: float = 0.45, hi: float = 0.72, n: int = 500,
                 key: str = "rule", digits: int = 6) -> DataFrame:
    """M2: pdf on n evenly spaced points of [lo, hi] per group (native
    expressions: explode(sequence) + lgamma)."""
    step = (hi - lo) / (n - 1)
    g = post.select(key, "alpha", "beta", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    x = F.lit(lo) + F.col("i") * F.lit(step)
    return g.select(key, F.col("i"), F.round(x, 10).alias("x"),
                    F.round(F.exp(beta_logpdf(x, F.col("alpha"), F.col("beta"))), digits).alias("density"))


def credible_interval(post: DataFrame, masses: Sequence[float] = (0.95, 0.75), digits: int = 4) -> DataFrame:
    """M3: central intervals per group (Beta quantiles, K4 pandas UDF)."""
    cols = {}
    for m in masses:
        tag = int(round(m * 100))
        lo_q, hi_q = (1 - m) / 2, 1 - (1 - m) / 2
        cols[f"lo_{tag}"] = F.round(beta_ppf(F.col("alpha"), F.col("beta"), F.lit(lo_q)), digits)
        cols[f"hi_{tag}"] = F.round(beta_ppf(F.col("alpha"), F.col("beta"), F.lit(hi_q)), digits)
    return post.withColumns(cols)


def prob_at_least(post: DataFrame, xs: Sequence[float], key: str = "rule", digits: int = 4) -> DataFrame:
    """M4: P(theta >= x) for each group and x (1 - CDF, K4 pandas UDF),
    distributed over group x point rows."""
    g = post.select(key, "alpha", "beta", F.explode(F.array(*[F.lit(float(x)) for x in xs])).alias("x"))
    return g.select(key, "x", F.round(F.lit(1.0) - beta_cdf("alpha", "beta", "x"), digits).alias("p_at_least"))


def rates(post: DataFrame, digits: int = 6) -> DataFrame:
    """M5: raw rate beside the shrunk (posterior mean) one."""
    return post.select("rule", "wins", "n", F.round(F.col("wins") / F.col("n"), digits).alias("raw_rate"),
                       F.round("posterior_mean", digits).alias("shrunk_rate"))


def ev(counts: DataFrame, price: float = -110.0, digits: int = 6) -> DataFrame:
    """M9: breakeven test and expected value per unit staked at an American price."""
    payout = 100.0 / -price if price < 0 else price / 100.0
    be = 1.0 / (1.0 + payout)
    r = F.col("wins") / F.col("n")
    return counts.select("rule", "wins", "n", F.round(r, digits).alias("rate"),
                         F.lit(round(be, 12)).alias("breakeven"), (r > F.lit(be)).alias("beats_breakeven"),
                         F.round(r * F.lit(payout) - (F.lit(1.0) - r), digits).alias("ev_per_unit"))


def logit_rates(counts: DataFrame, digits: int = 9) -> DataFrame:
    """Logit of the rate and its inverse (NULL at 0 or 1)."""
    r = F.col("wins") / F.col("n")
    ok = (r > 0) & (r < 1)
    lg = F.when(ok, logit(r))
    return counts.select("rule", F.round(lg, digits).alias("logit_rate"),
                         F.round(F.when(ok, expit(lg)), digits).alias("expit_logit"))


def season_drift(season_rates: DataFrame, high: float = 0.55, low: float = 0.50) -> DataFrame:
    """M8: rate by season with the next season's rate; flags an implausible
    level followed by a collapse (the look-ahead leakage signature).  The
    window runs over the per-season aggregate (a handful of rows)."""
    w = Window.orderBy("season")
    nxt = F.lead("rate").over(w)
    return season_rates.select("season", "n", "wins", "rate", nxt.alias("next_rate"),
                               F.coalesce((F.col("rate") > high) & (nxt < low), F.lit(False)).alias("drift_flag"))


# ---------------------------------------------------------------- M6 / M7 partial pooling

NODES = 31                            # Gauss-Hermite nodes per group and cell
SIDE = 36                             # (mu, sigma) nodes per axis
POINTS = 4001                         # density points per group
TOGETHER = 64                         # groups whose densities a task holds at a time


def _log_expit(e: np.ndarray) -> np.ndarray:
    return np.minimum(e, 0) - np.log1p(np.exp(-np.abs(e)))


def group_moments(wins, n, mu, sigma) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log L, E theta, E theta^2) of one group each, given mu and sigma, with its effect z ~ N(0, 1) integrated out."""
    w, n, mu, sg = (np.asarray(v, float) for v in (wins, n, mu, sigma))
    lo, hi = sg * (w - n), sg * w                           # the mode solves z = sigma * (wins - n * theta)
    z = np.clip((np.log((w + 0.5) / (n - w + 0.5)) - mu) / sg, lo, hi)
    for _ in range(200):
        p = 1 / (1 + np.exp(-(mu + sg * z)))
        slope = sg * (w - n * p) - z
        lo, hi = np.where(slope > 0, z, lo), np.where(slope > 0, hi, z)
        step = z + slope / (1 + sg * sg * n * p * (1 - p))
        step = np.where((step <= lo) | (step >= hi), 0.5 * (lo + hi), step)
        done = np.abs(step - z) <= 1e-9 * (1 + np.abs(z))
        z = step
        if done.all():
            break
    else:
        raise ArithmeticError("partial pooling: a group's mode was not found")
    p = 1 / (1 + np.exp(-(mu + sg * z)))
    width = np.sqrt(2 / (1 + sg * sg * n * p * (1 - p)))
    t, weight = np.polynomial.hermite.hermgauss(NODES)
    at = z[:, None] + width[:, None] * t
    eta = mu[:, None] + sg[:, None] * at
    g = w[:, None] * _log_expit(eta) + (n - w)[:, None] * _log_expit(-eta) - 0.5 * at * at
    top = g.max(1)
    f = np.exp(g - top[:, None] + t * t) * weight
    total = f.sum(1)
    theta = 1 / (1 + np.exp(-eta))
    return (top + np.log(total * width) - HALF_LN_2PI, (f * theta).sum(1) / total, (f * theta * theta).sum(1) / total)


@pandas_udf(StructType([StructField(c, DoubleType()) for c in ("logl", "m1", "m2")]))
def _moments(wins: pd.Series, n: pd.Series, mu: pd.Series, sigma: pd.Series) -> pd.DataFrame:
    logl, m1, m2 = group_moments(wins, n, mu, sigma)
    return pd.DataFrame({"logl": logl, "m1": m1, "m2": m2})


class Pooled:
    """The (mu, sigma) nodes with their posterior weights, and (wins, n, times, cell, logl, m1, m2) of every
    distinct pair of counts, `times` being the number of groups that have it: equal groups are one row a node."""

    def __init__(self, counts: DataFrame, p0: float, s_mu: float, s_sigma: float):
        mu0 = math.log(p0 / (1 - p0))
        self.counts = counts.select("rule", "wins", "n")
        counts = counts.groupBy("wins", "n").agg(F.count(F.lit(1)).alias("times"))
        box = (-7.0, 7.0, 0.0, 7.0)                         # u = (mu - mu0) / s_mu, v = sigma / s_sigma
        while True:
            half = [0.5 * (box[1] - box[0]), 0.5 * (box[3] - box[2])]
            nodes, gauss = np.polynomial.legendre.leggauss(SIDE)
            u, v = (x.ravel() for x in np.meshgrid(box[0] + half[0] * (1 + nodes), box[2] + half[1] * (1 + nodes)))
            du, dv = (math.pi * h / SIDE for h in half)     # distance of the nodes in the middle of the box
            self.mu, self.sigma = mu0 + s_mu * u, s_sigma * v
            self.span = s_mu * (box[1] - box[0])
            self.cells = self._evaluate(counts)
            sums = self.cells.groupBy("cell").agg(F.sum(F.col("times") * F.col("logl")).alias("s")).toPandas()   # SIDE^2 rows
            lp = -0.5 * (u * u + v * v)
            lp[sums["cell"].to_numpy()] += sums["s"].to_numpy()
            self.log_posterior = lp - lp.max()
            self.weight = np.exp(self.log_posterior) * np.outer(gauss, gauss).ravel()
            self.weight_top = self.weight.max()
            self.weight /= self.weight.sum()
            means = [float(self.weight @ x) for x in (u, v)]
            sds = [float(np.sqrt(self.weight @ (x - c) ** 2)) for x, c in zip((u, v), means)]
            if du <= 0.75 * sds[0] and dv <= 0.75 * sds[1]:
                return
            # Nodes too coarse: eight deviations around the mean (at least three nodes, where the sd is not resolved).
            reach = [max(8 * s, 3 * d) for s, d in zip(sds, (du, dv))]
            box = (max(box[0], means[0] - reach[0]), min(box[1], means[0] + reach[0]),
                   max(box[2], means[1] - reach[1]), min(box[3], means[1] + reach[1]))

    def _evaluate(self, counts: DataFrame) -> DataFrame:
        checkpoint_dir(counts.sparkSession)
        nodes = F.lit(np.stack([self.mu, self.sigma], 1).ravel())
        cell = F.explode(F.sequence(F.lit(0), F.lit(len(self.mu) - 1))).alias("cell")
        g = counts.select("wins", "n", "times", cell)
        pick = lambda k: F.get(nodes, 2 * F.col("cell") + k)
        g = g.select("wins", "n", "times", "cell", _moments("wins", "n", pick(0), pick(1)).alias("r"))
        return g.select("wins", "n", "times", "cell", "r.*").checkpoint(eager=True)

    def mixture(self) -> list[tuple[int, np.ndarray, np.ndarray, float, np.ndarray]]:
        """The posterior as components N(mu, sigma) close enough to add up smoothly: per node of sigma
        (its place, mu, weights, sigma, matrix from the nodes of mu to the components).

        Where sigma is narrower than the nodes of mu lie apart, values between them come from the polynomial
        through the nodes, which all these smooth functions of mu are close to.
        """
        nodes, gauss = np.polynomial.legendre.leggauss(SIDE)
        centre = 0.5 * (self.mu[0] + self.mu[SIDE - 1])
        pole = (-1.0) ** np.arange(SIDE) * np.sqrt((1 - nodes * nodes) * gauss)
        out = []
        for j in range(SIDE):
            sigma = float(self.sigma[j * SIDE])
            m = min(max(SIDE, math.ceil(2 * self.span / sigma)), 4000)
            at, g = (nodes, gauss) if m == SIDE else np.polynomial.legendre.leggauss(m)
            if m == SIDE:
                matrix = np.eye(SIDE)
            else:                                            # barycentric interpolation
                gap = at[:, None] - nodes
                gap[gap == 0] = 1e-300
                matrix = pole / gap
                matrix /= matrix.sum(1, keepdims=True)
            logs = self.log_posterior[j * SIDE:(j + 1) * SIDE] @ matrix.T
            weight = np.exp(logs) * g * gauss[j]
            keep = weight > 1e-10 * self.weight_top
            out.append((j, centre + 0.5 * self.span * at[keep], weight[keep], sigma, matrix[keep]))
        return out

    def per_rule(self) -> DataFrame:
        """(rule, wins, n, m1, m2): posterior moments of every group's rate."""
        w = F.get(F.lit(self.weight), F.col("cell"))
        return self.of_rules(self.cells.groupBy("wins", "n").agg(F.sum(w * F.col("m1")).alias("m1"), F.sum(w * F.col("m2")).alias("m2")))

    def of_rules(self, found: DataFrame) -> DataFrame:
        """What was found for a pair of counts, for every group that has it."""
        return self.counts.join(found, ["wins", "n"])


def partial_pooling(counts: DataFrame, p0: float = BREAKEVEN, s_mu: float = 0.3, s_sigma: float = 0.4,
                    digits: int = 6) -> DataFrame:
    """M6 `stat_partial_pooling`: mu ~ N(logit p0, s_mu), sigma ~ HalfN(s_sigma),
    theta_i = expit(mu + sigma z_i), wins_i ~ Bin(n_i, theta_i); posterior
    means of theta_i, mu and sigma by quadrature."""
    fit = Pooled(counts, p0, s_mu, s_sigma)
    return fit.per_rule().select(
        "rule", "wins", "n", F.round("m1", digits).alias("theta_mean"),
        F.round(F.lit(float(fit.weight @ fit.mu)), digits).alias("mu_mean"),
        F.round(F.lit(float(fit.weight @ fit.sigma)), digits).alias("sigma_mean"))


def density_intervals(wins, n, mean, sd, mixture, logl, mass: float) -> tuple[np.ndarray, np.ndarray]:
    """Ends of equal density that hold `mass` of the marginal posteriors of a batch of groups (logl: groups x nodes)."""
    wins, n, mean, sd = (np.asarray(v, float)[:, None] for v in (wins, n, mean, sd))
    lo, hi = np.maximum(mean - 9 * sd, 1e-12), np.minimum(mean + 9 * sd, 1 - 1e-12)
    h = (hi - lo) / (POINTS - 1)
    t = lo + h * np.arange(POINTS)
    eta = np.log(t) - np.log1p(-t)
    base = wins * _log_expit(eta) + (n - wins) * _log_expit(-eta) - np.log(t) - np.log1p(-t)
    f = np.zeros(t.shape)
    for j, mu, weight, s, matrix in mixture:                             # over the components, all groups at once
        own = logl[:, j * SIDE:(j + 1) * SIDE] @ matrix.T
        for k, (m, w) in enumerate(zip(mu, weight)):
            f += np.exp(base - 0.5 * ((eta - m) / s) ** 2 + (math.log(w / s) - own[:, k:k + 1]))
    cdf = np.concatenate([np.zeros((len(f), 1)), np.cumsum(0.5 * h * (f[:, 1:] + f[:, :-1]), axis=1)], axis=1)
    f, cdf = f / cdf[:, -1:], cdf / cdf[:, -1:]
    row, peak = np.arange(len(f)), f.argmax(axis=1)
    left = np.arange(POINTS) <= peak[:, None]
    at = lambda x, k: x[row, k]

    def crossing(level, side):
        """Place and CDF where the density meets the level, on one side of the peak; at the range's end if it does not."""
        below = f < level[:, None]
        if side < 0:
            inner = (below & left).sum(axis=1)                           # first point of the level or more
            outer = np.maximum(inner - 1, 0)
        else:
            inner = POINTS - 1 - (below & ~left).sum(axis=1)
            outer = np.minimum(inner + 1, POINTS - 1)
        gap = at(f, inner) - at(f, outer)
        share = np.where(gap > 0, (level - at(f, outer)) / np.where(gap > 0, gap, 1), 0.0)
        return tuple(at(x, outer) + share * (at(x, inner) - at(x, outer)) for x in (t, cdf))

    low, high = np.zeros(len(f)), at(f, peak)
    for _ in range(200):                                                 # the levels whose intervals hold the mass
        level = 0.5 * (low + high)
        (a, ca), (b, cb) = crossing(level, -1), crossing(level, 1)
        wide = cb - ca > mass
        low, high = np.where(wide, level, low), np.where(wide, high, level)
    return a, b


def hdi(counts: DataFrame, mass: float = 0.94, p0: float = BREAKEVEN, s_mu: float = 0.3, s_sigma: float = 0.4,
        digits: int = 6) -> DataFrame:
    """M7 `stat_hdi`: the shortest interval holding `mass` of each group's pooled posterior (M6).

    A row per distinct pair of counts carries its log likelihood at the
    (mu, sigma) nodes; TOGETHER rows are worked on at a time."""
    fit = Pooled(counts, p0, s_mu, s_sigma)
    weight, mixture = fit.weight, fit.mixture()
    rows = fit.cells.groupBy("wins", "n").agg(F.sort_array(F.collect_list(F.struct("cell", "logl", "m1", "m2"))).alias("c"))

    @pandas_udf("lo double, hi double")
    def ends(wins: pd.Series, n: pd.Series, logl: pd.Series, m1: pd.Series, m2: pd.Series) -> pd.DataFrame:
        out = []
        for i in range(0, len(wins), TOGETHER):
            w, k, ll, a, b = (np.stack(x[i:i + TOGETHER].to_numpy()) for x in (wins, n, logl, m1, m2))
            mean = a @ weight
            sd = np.sqrt(np.maximum(b @ weight - mean * mean, 1e-300))
            out.append(np.stack(density_intervals(w, k, mean, sd, mixture, ll, mass), axis=1))
        return pd.DataFrame(np.concatenate(out) if out else np.zeros((0, 2)), columns=["lo", "hi"])

    r = fit.of_rules(rows.select("wins", "n", ends("wins", "n", "c.logl", "c.m1", "c.m2").alias("r")))
    return r.select("rule", F.round("r.lo", digits).alias("hdi_lo"), F.round("r.hi", digits).alias("hdi_hi"))
