"""Least squares, logistic regression, walk-forward fits and
market-implied ratings.

Everything a fit needs from the rows is a sum of products, so a group's
sufficient statistics are one partial aggregate (a group that holds a third of
all rows is one short row a task) and they add up over groups: a walk-forward
fit of every season is a running sum over the seasons' statistics, not a scan
a season.  The normal equations are solved in the plan itself, by elimination
on an array column with a rank check; no model is fitted on the driver.

Rank check: features are eliminated in the order given; one whose remaining
sum of squares is below RANK_TOL of its own is a combination of the intercept
and earlier features (a constant column is), gets a NULL coefficient and counts
as absent.  Rows with a NULL in the target or a feature take no part in a fit.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import new_path

RANK_TOL = 1e-9
INTERCEPT = "intercept"


def era(season: Column, cut: int = 2021) -> Column:
    """The two eras of a rule change in season `cut`."""
    return F.when(season < cut, F.lit(f"before_{cut}")).when(season >= cut, F.lit(f"from_{cut}"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _design(df: DataFrame, keep: Sequence[str], xs: Sequence[str], y: str) -> DataFrame:
    """keep…, x0 = 1, x1…, y as doubles; rows with a NULL among them left out."""
    cols = [F.lit(1.0).alias("x0"), *(F.col(x).cast("double").alias(f"x{i}") for i, x in enumerate(xs, 1)),
            F.col(y).cast("double").alias("y")]
    return df.select(*keep, *cols).dropna(subset=[*(f"x{i}" for i in range(1, len(xs) + 1)), "y"])


def _products(names: Sequence[str], weight: Column | None = None) -> list[Column]:
    """Sums of all products of two of `names`, as s_i_j for i <= j."""
    out = []
    for i, a in enumerate(names):
        for j, b in enumerate(names[i:], i):
            v = F.col(a) * F.col(b)
            out.append(F.sum(v if weight is None else weight * v).alias(f"s_{i}_{j}"))
    return out


def _system(p: int, rhs: Sequence[Column]) -> Column:
    """The rows [X'X | X'y | I] of a group's normal equations."""
    rows = []
    for i in range(p):
        left = [F.col(f"s_{min(i, j)}_{max(i, j)}") for j in range(p)]
        rows.append(F.array(*left, rhs[i], *(F.lit(float(i == j)) for j in range(p))))
    return F.array(*rows)


def solve(system: Column, p: int, tol: float = RANK_TOL) -> Column:
    """Reduced rows of a positive semi-definite system [A | …]; row and column of a dependent unknown are zero.

    Gauss-Jordan elimination as one fold over the unknowns, in their order.
    """
    own = [F.get(F.get(system, F.lit(k)), F.lit(k)) for k in range(p)]

    def eliminate(rows: Column, k: int) -> Column:
        row = F.get(rows, F.lit(k))
        pivot = F.get(row, F.lit(k))
        reduced = F.transform(rows, lambda r, i: F.when(i == k, F.transform(row, lambda v: v / pivot)).otherwise(
            F.zip_with(r, row, lambda a, b: a - F.get(r, F.lit(k)) / pivot * b)))
        without = F.transform(rows, lambda r, i: F.transform(r, lambda v, j: F.when(
            (i == k) | (j == k), F.lit(0.0)).otherwise(v)))
        return F.when(pivot > tol * own[k], reduced).otherwise(without)

    steps = F.array(*(F.lit(k) for k in range(p)))
    return F.aggregate(steps, system, lambda rows, k: reduce(
        lambda out, i: F.when(k == i, eliminate(rows, i)).otherwise(out), range(p), rows))


def _unknown(rows: Column, p: int, k: int) -> Column:
    """The k-th unknown, NULL if dependent."""
    row = F.get(rows, F.lit(k))
    return F.when(F.get(row, F.lit(p + 1 + k)) > 0, F.get(row, F.lit(p)))


def _terms(solved: DataFrame, keep: Sequence[str], names: Sequence[str], columns: dict[str, list[Column]]) -> DataFrame:
    """One row per group and term."""
    terms = F.array(*(F.struct(F.lit(i).alias("position"), F.lit(n).alias("term"),
                               *(v[i].alias(c) for c, v in columns.items())) for i, n in enumerate(names)))
    return solved.select(*keep, F.inline(terms))


def fit_ols(df: DataFrame, by: Sequence[str], xs: Sequence[str], y: str) -> DataFrame:
    """P1 `model_ols_era`: ordinary least squares per group, in one aggregate.

    Rows (by…, n, rank, position, term, coefficient, std_error); the standard
    error is NULL without a degree of freedom to spare.
    """
    p = len(xs) + 1
    names = [*(f"x{i}" for i in range(p)), "y"]
    sums = _design(df, by, xs, y).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *_products(names))
    rhs = [F.col(f"s_{i}_{p}") for i in range(p)]
    fit = sums.withColumn("rows", solve(_system(p, rhs), p))
    b = [_unknown(F.col("rows"), p, k) for k in range(p)]
    fit = fit.withColumn("rank", sum((v.isNotNull().cast("int") for v in b), F.lit(0)))
    sse = F.col(f"s_{p}_{p}") - sum((F.coalesce(v, F.lit(0.0)) * r for v, r in zip(b, rhs)), F.lit(0.0))
    fit = fit.withColumn("variance", F.when(F.col("n") > F.col("rank"), F.greatest(sse, F.lit(0.0)) / (F.col("n") - F.col("rank"))))
    error = [F.when(v.isNotNull(), F.sqrt(F.col("variance") * F.get(F.get("rows", F.lit(k)), F.lit(p + 1 + k))))
             for k, v in enumerate(b)]
    return _terms(fit, [*by, "n", "rank"], [INTERCEPT, *xs], {"coefficient": b, "std_error": error})


def fit_logit(df: DataFrame, by: Sequence[str], xs: Sequence[str], y: str, max_iter: int = 30, tol: float = 1e-9) -> DataFrame:
    """P2 `model_logit_era`: logistic regression of a 0/1 target per group by
    reweighted least squares.

    Rows (by…, n, iterations, status, position, term, coefficient).  The design
    is written once; an iteration is one aggregate over the rows of the groups
    still at work, whose coefficients (a row a group) are joined on.  A group
    stops when no coefficient moves by more than tol, relative to the largest.
    Status 'converged'; or 'separated', with NULL coefficients, where the
    likelihood has no finite maximum: every fitted value within 1e-6 of its
    target, or no convergence in max_iter iterations.
    """
    p = len(xs) + 1
    xcols = [f"x{i}" for i in range(p)]
    rows = _stored(_design(df, by, xs, y), "logit-rows")
    groups = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    state = _stored(groups.select(*by, "n", F.array(*(F.lit(0.0) for _ in xcols)).alias("beta"), F.lit(0).alias("iterations"),
                                  F.lit(None).cast("string").alias("status"),
                                  F.array(*(F.lit(False) for _ in xcols)).alias("absent")), "logit-state")
    done = state.filter("status IS NOT NULL")
    for _ in range(max_iter):
        if state.isEmpty():
            break
        eta = sum((F.get("beta", F.lit(i)) * F.col(x) for i, x in enumerate(xcols)), F.lit(0.0))
        at = rows.join(state.select(*by, "beta"), list(by)).withColumn("mu", 1 / (1 + F.exp(-eta)))
        miss = F.col("y") - F.col("mu")
        sums = at.groupBy(*by).agg(*_products(xcols, F.col("mu") * (1 - F.col("mu"))), F.max(F.abs(miss)).alias("miss"),
                                   *(F.sum(F.col(x) * miss).alias(f"g_{i}") for i, x in enumerate(xcols)))
        step = sums.withColumn("rows", solve(_system(p, [F.col(f"g_{i}") for i in range(p)]), p)).select(
            *by, "miss", F.array(*(F.coalesce(_unknown(F.col("rows"), p, k), F.lit(0.0)) for k in range(p))).alias("step"),
            F.array(*(_unknown(F.col("rows"), p, k).isNull() for k in range(p))).alias("absent"))
        moved = state.drop("absent").join(step, list(by)).withColumn("beta", F.zip_with("beta", "step", lambda a, b: a + b))
        size = lambda c: F.aggregate(c, F.lit(0.0), lambda m, v: F.greatest(m, F.abs(v)))
        settled = size(F.col("step")) <= tol * F.greatest(F.lit(1.0), size(F.col("beta")))
        moved = moved.select(*by, "n", "beta", (F.col("iterations") + 1).alias("iterations"), F.when(
            F.col("miss") < 1e-6, F.lit("separated")).when(settled, F.lit("converged")).alias("status"), "absent")
        state = _stored(moved, "logit-state")
        done = done.unionByName(state.filter("status IS NOT NULL"))
        state = state.filter("status IS NULL")
    fit = done.unionByName(state.withColumn("status", F.lit("separated")))
    b = [F.when((F.col("status") == "converged") & ~F.get("absent", F.lit(k)), F.get("beta", F.lit(k))) for k in range(p)]
    return _terms(fit, [*by, "n", "iterations", "status"], [INTERCEPT, *xs], {"coefficient": b})


def walk_forward(df: DataFrame, season: str, xs: Sequence[str], y: str, by: Sequence[str] = ()) -> DataFrame:
    """P3 `eval_walk_forward`: every row with the least-squares prediction of a
    fit on all earlier seasons (of its `by` group): adds n_train, predicted.

    One scan makes the sums of products per season; their running totals over
    the earlier seasons (a window over one row a season) are every season's
    normal equations.  `predicted` is NULL without an earlier season or with a
    NULL feature; features that depend on earlier ones in the training rows
    count as 0.
    """
    p = len(xs) + 1
    names = [*(f"x{i}" for i in range(p)), "y"]
    keys = [*by, season]
    sums = _design(df.filter(F.col(season).isNotNull()), keys, xs, y).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *_products(names))
    seasons = df.filter(F.col(season).isNotNull()).groupBy(*keys).agg(F.lit(1).alias("__one")).drop("__one")
    stats = [c for c in sums.columns if c not in keys]
    ahead = Window.partitionBy(*by).orderBy(season).rowsBetween(Window.unboundedPreceding, -1)
    upto = seasons.join(sums, keys, "left").select(*keys, *(F.sum(c).over(ahead).alias(c) for c in stats))
    fit = upto.withColumn("rows", solve(_system(p, [F.col(f"s_{i}_{p}") for i in range(p)]), p))
    beta = F.array(*(F.coalesce(_unknown(F.col("rows"), p, k), F.lit(0.0)) for k in range(p)))
    fit = fit.filter("n > 0").select(*keys, F.col("n").alias("n_train"), beta.alias("__beta"))
    value = sum((F.get("__beta", F.lit(i)) * F.col(x).cast("double") for i, x in enumerate(xs, 1)), F.get("__beta", F.lit(0)))
    return df.join(fit, keys, "left").withColumns({
        "n_train": F.coalesce("n_train", F.lit(0)), "predicted": value}).drop("__beta")


def power_rating(games: DataFrame, by: str = "season", home: str = "home_team", away: str = "away_team",
                 line: str = "mode_spread", neutral: str | None = "neutral_site", line_sign: int = -1,
                 tol: float = 1e-11, max_iter: int = 500) -> DataFrame:
    """P6 `rating_market_implied`: rows (by, team, rating, home_edge, games):
    ratings whose differences, plus one home edge per group where the site is
    not neutral, fit the lines best in least squares.

    `line_sign` -1: a negative line favours the home side.  Games without a
    line, a team or a group, and of a team against itself, take no part; an
    unknown site is a home site.  Ratings sum to 0 within each set of teams
    that games connect (the solution of least norm).

    The normal equations are a sparse matrix in rows (group, i, j, value), one
    per pair of teams that met, and are solved for all groups at once by
    conjugate gradients from 0: a matrix-vector product is a join on j and a
    partial aggregate on i, the scalars are aggregates per group.  Groups leave
    the iteration once their residual's norm is tol of the right side's; no
    convergence in max_iter iterations is an error.  The driver sees how many
    groups are left, nothing of the matrix or the vectors; every iteration is
    written, so a lost executor costs one.
    """
    node = lambda c: F.concat(F.lit("t"), F.col(c).cast("string"))
    at_home = F.lit(True) if neutral is None else ~F.coalesce(F.col(neutral), F.lit(False))
    known = games.filter(F.col(by).isNotNull() & F.col(line).isNotNull() & (F.col(home) != F.col(away)))
    pairs = known.groupBy(F.col(by).alias("grp"), node(home).alias("h"), node(away).alias("a"), at_home.alias("at_home")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(line_sign * F.col(line).cast("double")).alias("margin"))
    term = lambda c, v: F.struct(c.alias("node"), F.lit(v).alias("c"))
    sides = F.array(term(F.col("h"), 1.0), term(F.col("a"), -1.0))
    pairs = _stored(pairs.withColumn("terms", F.when(F.col("at_home"), F.concat(sides, F.array(term(F.lit("edge"), 1.0))))
                                     .otherwise(sides)), "rating-pairs")
    one = pairs.select("grp", "n", "margin", "terms", F.inline("terms")).withColumnsRenamed({"node": "i", "c": "ci"})
    matrix = _stored(one.select("grp", "n", "i", "ci", F.inline("terms")).groupBy("grp", "i", F.col("node").alias("j"))
                     .agg(F.sum(F.col("n") * F.col("ci") * F.col("c")).alias("v")), "rating-matrix")
    right = one.groupBy("grp", F.col("i").alias("node")).agg(F.sum(F.col("ci") * F.col("margin")).alias("r"),
                                                           F.sum("n").alias("games"))
    state = right.select("grp", "node", "games", F.lit(0.0).alias("x"), "r", F.lit(0.0).alias("p"), F.lit(0.0).alias("rr"))
    state = _stored(state, "rating-state")
    bound = _stored(state.groupBy("grp").agg((F.sum(F.col("r") * F.col("r")) * tol * tol).alias("bound")), "rating-bound")
    done = []
    for _ in range(max_iter + 1):
        # residual norms, the groups that have reached theirs, and the next direction of the others
        norms = state.groupBy("grp").agg(F.sum(F.col("r") * F.col("r")).alias("rr_now"))
        state = state.join(norms.join(bound, "grp"), "grp")
        ahead = F.col("r") + F.when(F.col("rr") > 0, F.col("rr_now") / F.col("rr")).otherwise(F.lit(0.0)) * F.col("p")
        state = _stored(state.select("grp", "node", "games", "x", "r", ahead.alias("p"), F.col("rr_now").alias("rr"),
                                     (F.col("rr_now") <= F.col("bound")).alias("ready")), "rating-state")
        done.append(state.filter("ready").select("grp", "node", "games", "x"))
        state = state.filter("NOT ready").drop("ready")
        if state.isEmpty():
            break
        product = matrix.join(state.select("grp", F.col("node").alias("j"), "p"), ["grp", "j"]).groupBy(
            "grp", F.col("i").alias("node")).agg(F.sum(F.col("v") * F.col("p")).alias("ap"))
        state = _stored(state.join(product, ["grp", "node"]), "rating-state")
        length = state.groupBy("grp").agg((F.max("rr") / F.sum(F.col("p") * F.col("ap"))).alias("step"))
        state = state.join(length, "grp").select("grp", "node", "games", (F.col("x") + F.col("step") * F.col("p")).alias("x"),
                                                 (F.col("r") - F.col("step") * F.col("ap")).alias("r"), "p", "rr")
    else:
        raise RuntimeError(f"power ratings did not converge in {max_iter} iterations")
    found = reduce(DataFrame.unionByName, done)
    edge = found.filter("node = 'edge'").select("grp", F.col("x").alias("home_edge"))
    teams = found.filter("node <> 'edge'").join(edge, "grp", "left")
    return teams.select(F.col("grp").alias(by), F.expr("substring(node, 2)").cast(games.schema[home].dataType).alias("team"),
                        F.col("x").alias("rating"), "home_edge", "games")
