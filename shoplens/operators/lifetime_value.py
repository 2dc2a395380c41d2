"""Customer lifetime value: BG/NBD purchases, Gamma-Gamma spend, discounted twelve months.

Formulas: Fader, Hardie and Lee (2005) for BG/NBD, Fader and Hardie (2013) for Gamma-Gamma.
Likelihood sums run on the executors, one Spark job per optimizer step; the driver only holds the
two to four parameters.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.expressions import clip_lower, number
from shoplens.functions.order_stats import cut_at, inner_edges, label_of
from shoplens.functions.special import digamma, gammaln, hyp2f1
from shoplens.sources.stages import store

BGNBD_PENALTY = 0.1
GAMMA_PENALTY = 0.001
MONTH_DAYS = 30
HORIZON_MONTHS = 12
MONTHLY_DISCOUNT = 0.01

# Value tiers in ascending order and the quantiles between them.
TIERS = ("Low Value", "Mid Value", "High Value")
TIER_CUTS = (0.5, 0.8)


def clv_summary_input(clean: DataFrame, observed_to: Column | None = None) -> DataFrame:
    """Repeat purchase days, recency, age and mean spend of repeat days per customer.

    Lines fold into customer days first, so a hot customer reaches the second aggregation as at
    most one row per day. The customer days are stored: the end of observation is read from them
    and the transactions are read once.
    """
    by_day = store(
        clean.groupBy("CustomerID", F.to_date("InvoiceDate").alias("Day")).agg(
            F.sum("TotalPrice").cast("decimal(35,4)").alias("Spend")
        ),
        "customer-days",
    )
    if observed_to is None:
        observed_to = by_day.agg(F.max("Day")).scalar()
    else:
        by_day = by_day.filter(F.col("Day") <= observed_to)
    first, last, repeats = F.min("Day"), F.max("Day"), F.count(F.lit(1)) - 1
    repeat_spend = (F.sum("Spend") - F.min_by("Spend", "Day")).cast("double")
    return by_day.groupBy("CustomerID").agg(
        repeats.alias("frequency"),
        F.date_diff(last, first).alias("recency"),
        F.date_diff(observed_to, first).alias("T"),
        F.when(repeats > 0, repeat_spend / repeats).otherwise(0.0).alias("monetary_value"),
    )


def fill_missing_spend(summary: DataFrame) -> DataFrame:
    return summary.withColumn(
        "monetary_value", F.coalesce(number(F.col("monetary_value")), F.lit(0.0))
    )


def repeat_buyers(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("frequency") > 0)


def repeat_buyer_counts(summary: DataFrame) -> DataFrame:
    repeat = F.col("frequency") > 0
    return summary.agg(
        F.count_if(~repeat).alias("OneTime"),
        F.avg((~repeat).cast("int")).alias("OneTimeShare"),
        F.count_if(repeat).alias("Repeat"),
        F.avg(repeat.cast("int")).alias("RepeatShare"),
    )


def frequency_spend_correlation(summary: DataFrame) -> DataFrame:
    """Pearson correlation among repeat buyers; the spend model expects it near 0."""
    return repeat_buyers(summary).agg(
        F.corr(F.col("frequency").cast("double"), "monetary_value").alias("Correlation")
    )


@dataclass(frozen=True)
class BgNbd:
    """Purchase rate gamma(r, alpha); dropout beta(a, b)."""

    r: float
    alpha: float
    a: float
    b: float


@dataclass(frozen=True)
class GammaGamma:
    """Spend gamma(p, nu); nu gamma(q, v)."""

    p: float
    q: float
    v: float


def bgnbd_log_likelihood(theta: np.ndarray, x, recency, age) -> tuple[np.ndarray, np.ndarray]:
    """Per-customer log-likelihood and its gradient (one row per parameter)."""
    r, alpha, a, b = theta
    alive = -(r + x) * np.log(alpha + age)
    again = np.maximum(x, 1)
    with np.errstate(divide="ignore"):
        gone = np.where(
            x > 0, np.log(a) - np.log(b + again - 1) - (r + x) * np.log(alpha + recency), -np.inf
        )
    top = np.maximum(alive, gone)
    mixed = top + np.log(np.exp(alive - top) + np.exp(gone - top))
    value = (
        gammaln(r + x)
        - gammaln(r)
        + r * np.log(alpha)
        + gammaln(a + b)
        + gammaln(b + x)
        - gammaln(b)
        - gammaln(a + b + x)
        + mixed
    )
    w_gone = np.exp(gone - mixed)
    w_alive = 1 - w_gone
    log_mean = w_alive * np.log(alpha + age) + w_gone * np.log(alpha + recency)
    inverse_mean = w_alive / (alpha + age) + w_gone / (alpha + recency)
    gradient = np.stack(
        [
            digamma(r + x) - digamma(r) + np.log(alpha) - log_mean,
            r / alpha - (r + x) * inverse_mean,
            digamma(a + b) - digamma(a + b + x) + w_gone / a,
            digamma(a + b)
            + digamma(b + x)
            - digamma(b)
            - digamma(a + b + x)
            - w_gone / (b + again - 1),
        ]
    )
    return value, gradient


def gamma_gamma_log_likelihood(theta: np.ndarray, x, spend) -> tuple[np.ndarray, np.ndarray]:
    """Per-customer log-likelihood of mean spend over x > 0 repeat purchases, and gradient."""
    p, q, v = theta
    shape = p * x
    total = x * spend + v
    value = (
        gammaln(shape + q)
        - gammaln(shape)
        - gammaln(q)
        + q * np.log(v)
        + (shape - 1) * np.log(spend)
        + shape * np.log(x)
        - (shape + q) * np.log(total)
    )
    joint = digamma(shape + q)
    gradient = np.stack(
        [
            x * (joint - digamma(shape) + np.log(spend) + np.log(x) - np.log(total)),
            joint - digamma(q) + np.log(v) - np.log(total),
            q / v - (shape + q) / total,
        ]
    )
    return value, gradient


Likelihood = Callable[..., tuple[np.ndarray, np.ndarray]]


def likelihood_sums(
    frame: DataFrame, likelihood: Likelihood, columns: list[str], thetas: list[np.ndarray]
) -> list[tuple[float, float, np.ndarray]]:
    """Weight, log-likelihood and gradient sums at each parameter vector, in one job.

    ``columns`` are the model inputs followed by the row weight. Every task returns one row per
    parameter vector.
    """
    width = len(thetas[0])

    def partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((len(thetas), 2 + width))
        for batch in batches:
            *inputs, weight = (batch[c].to_numpy(dtype=float) for c in columns)
            for i, theta in enumerate(thetas):
                value, gradient = likelihood(theta, *inputs)
                sums[i, 0] += weight.sum()
                sums[i, 1] += weight @ value
                sums[i, 2:] += gradient @ weight
        names = ["n", "value", *[f"g{j}" for j in range(width)]]
        out = pd.DataFrame(sums, columns=names)
        out.insert(0, "trial", np.arange(len(thetas)))
        yield out

    sum_names = ["n", "value", *[f"g{j}" for j in range(width)]]
    schema = "trial int, " + ", ".join(f"{c} double" for c in sum_names)
    rows = (
        frame.select(*columns)
        .mapInPandas(partial_sums, schema)
        .groupBy("trial")
        .agg(*[F.sum(c).alias(c) for c in sum_names])
        .collect()  # one row per trial
    )
    return [
        (r.n, r.value, np.array([r[f"g{j}"] for j in range(width)]))
        for r in sorted(rows, key=lambda r: r.trial)
    ]


@dataclass(frozen=True)
class Fit:
    """Fitted parameters (natural scale), their standard errors and how the search ended.

    An error is None where the likelihood is flat: at a parameter that has run to its boundary, and
    everywhere if the curvature of the others is not that of a maximum.
    """

    parameters: tuple[float, ...]
    errors: tuple[float | None, ...]
    objective: float
    steps: int
    stop: str


def _fit(
    frame: DataFrame,
    likelihood: Likelihood,
    columns: list[str],
    width: int,
    penalty: float,
    tolerance: float = 1e-6,
    max_steps: int = 200,
) -> Fit:
    """Minimize -mean log-likelihood + penalty * sum(theta^2) over log-parameters (BFGS).

    A step costs one Spark job; only when the full step fails are shorter ones tried, all in one
    more job.
    """

    customers = 0.0

    def evaluate(points: list[np.ndarray]) -> list[tuple[float, np.ndarray]]:
        nonlocal customers
        thetas = [np.exp(p) for p in points]
        out = []
        for theta, (n, value, gradient) in zip(
            thetas, likelihood_sums(frame, likelihood, columns, thetas)
        ):
            customers = n
            objective = -value / n + penalty * np.sum(theta**2)
            slope = (-gradient / n + 2 * penalty * theta) * theta
            out.append((objective if np.isfinite(objective) else np.inf, slope))
        return out

    point = np.zeros(width)
    ((objective, slope),) = evaluate([point])
    if not np.isfinite(objective):
        raise ArithmeticError("the likelihood is not finite at the start; is the table empty?")
    inverse = np.eye(width)
    standing, stop = 0, "gradient below tolerance"
    for step in range(max_steps):
        if np.max(np.abs(slope)) < tolerance:
            break
        direction = -inverse @ slope
        if direction @ slope >= 0:
            inverse, direction = np.eye(width), -slope
        direction *= min(1.0, 4.0 / np.max(np.abs(direction)))
        usable = []
        for lengths in ([1.0], [0.4, 0.15, 0.04, 0.005]):
            trials = evaluate([point + t * direction for t in lengths])
            usable = [
                (t, f, g)
                for t, (f, g) in zip(lengths, trials)
                if f <= objective + 1e-4 * t * (direction @ slope)
            ]
            if usable:
                break
        if not usable:
            if np.max(np.abs(slope)) < 1e-4:
                stop = "rounding hides further progress"
                break
            if np.array_equal(inverse, np.eye(width)):
                raise ArithmeticError("the line search failed to improve the likelihood")
            inverse = np.eye(width)
            continue
        length, new_objective, new_slope = min(usable, key=lambda u: u[1])
        moved, turned = length * direction, new_slope - slope
        curvature = moved @ turned
        if curvature > 1e-12:
            if step == 0:
                inverse = np.eye(width) * curvature / (turned @ turned)
            left = np.eye(width) - np.outer(moved, turned) / curvature
            inverse = left @ inverse @ left.T + np.outer(moved, moved) / curvature
        gained = objective - new_objective
        point, objective, slope = point + moved, new_objective, new_slope
        # A parameter running to its boundary keeps moving long after the objective stands still.
        standing = standing + 1 if gained < 1e-8 * max(1.0, abs(objective)) else 0
        if standing == 3:
            stop = "objective stands still"
            break
    else:
        raise ArithmeticError(f"the likelihood fit did not converge in {max_steps} steps")

    # Standard errors: Hessian by central differences of the gradient, delta method to theta.
    nudge = 1e-4
    shifted = evaluate(
        [point + sign * nudge * np.eye(width)[j] for j in range(width) for sign in (1, -1)]
    )
    hessian = np.array(
        [(shifted[2 * j][1] - shifted[2 * j + 1][1]) / (2 * nudge) for j in range(width)]
    )
    theta = np.exp(point)
    errors = _errors((hessian + hessian.T) / 2, theta, customers)
    return Fit(tuple(theta), errors, float(objective), step, stop)


def _errors(hessian: np.ndarray, theta: np.ndarray, customers: float) -> tuple[float | None, ...]:
    """Standard errors from the curvature of the mean objective over the log-parameters."""
    bend = np.diag(hessian)
    inside = np.flatnonzero(bend > 1e-5 * max(bend.max(), 0.0))
    errors: list[float | None] = [None] * len(theta)
    own = hessian[np.ix_(inside, inside)]
    if len(inside) and np.linalg.eigvalsh(own).min() > 0:
        spread = np.diag(np.linalg.inv(own)) * theta[inside] ** 2 / customers
        for place, variance in zip(inside, spread):
            errors[place] = float(np.sqrt(variance))
    return tuple(errors)


def fit_bgnbd(summary: DataFrame, penalty: float = BGNBD_PENALTY) -> tuple[BgNbd, DataFrame]:
    """Fit the purchase model; returns it with its coefficient table.

    Time is rescaled so the longest age is 1 while fitting, as the penalty assumes. Customers
    with equal counts are one weighted row.
    """
    triples = summary.groupBy("frequency", "recency", "T").agg(
        F.count(F.lit(1)).cast("double").alias("weight")
    )
    triples = store(triples, "bgnbd-input")
    longest = triples.agg(F.max("T")).first()[0]
    if longest is None:
        raise ValueError("no customers to fit")
    scale = 1.0 / max(longest, 1)
    scaled = triples.select(
        "frequency",
        (F.col("recency") * scale).alias("recency"),
        (F.col("T") * scale).alias("T"),
        "weight",
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fit = _fit(
            scaled, bgnbd_log_likelihood, ["frequency", "recency", "T", "weight"], 4, penalty
        )
    finally:
        scaled.unpersist()
    unit = np.array([1.0, 1.0 / scale, 1.0, 1.0])
    values = np.array(fit.parameters) * unit
    errors = [e if e is None else e * u for e, u in zip(fit.errors, unit)]
    table = _coefficients(summary, ("r", "alpha", "a", "b"), values, errors, fit.stop)
    return BgNbd(*map(float, values)), table


def fit_gamma_gamma(
    summary: DataFrame, penalty: float = GAMMA_PENALTY
) -> tuple[GammaGamma, DataFrame]:
    """Fit the spend model on repeat buyers; returns it with its coefficient table."""
    buyers = repeat_buyers(summary).filter(F.col("monetary_value") > 0)
    buyers = buyers.groupBy("frequency", "monetary_value").agg(
        F.count(F.lit(1)).cast("double").alias("weight")
    )
    buyers = store(buyers, "gamma-input").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fit = _fit(
            buyers, gamma_gamma_log_likelihood, ["frequency", "monetary_value", "weight"], 3,
            penalty,
        )
    finally:
        buyers.unpersist()
    table = _coefficients(summary, ("p", "q", "v"), fit.parameters, fit.errors, fit.stop)
    return GammaGamma(*map(float, fit.parameters)), table


def _coefficients(frame: DataFrame, names, values, errors, stop: str) -> DataFrame:
    """One row per parameter; without an error the parameter is at its boundary."""
    rows = []
    for name, v, e in zip(names, values, errors):
        bounds = (None, None) if e is None else (float(v - 1.96 * e), float(v + 1.96 * e))
        rows.append((name, float(v), None if e is None else float(e), *bounds, e is None, stop))
    return frame.sparkSession.createDataFrame(
        rows,
        "Parameter string, Coef double, StdErr double, Lower95 double, Upper95 double, "
        "NoError boolean, Stop string",
    )


def bgnbd_loglik(summary: DataFrame, model: BgNbd) -> DataFrame:
    """Customers and total log-likelihood at known parameters."""
    theta = np.array([model.r, model.alpha, model.a, model.b])
    weighted = summary.withColumn("weight", F.lit(1.0))
    ((n, value, _),) = likelihood_sums(
        weighted, bgnbd_log_likelihood, ["frequency", "recency", "T", "weight"], [theta]
    )
    return _loglik_row(summary, n, value)


def gamma_gamma_loglik(summary: DataFrame, model: GammaGamma) -> DataFrame:
    theta = np.array([model.p, model.q, model.v])
    buyers = repeat_buyers(summary).filter(F.col("monetary_value") > 0)
    ((n, value, _),) = likelihood_sums(
        buyers.withColumn("weight", F.lit(1.0)),
        gamma_gamma_log_likelihood,
        ["frequency", "monetary_value", "weight"],
        [theta],
    )
    return _loglik_row(summary, n, value)


def _objectives(frame, likelihood, columns, points, units, penalty):
    """Rows of weight, and for each parameter list what the fit minimises."""
    thetas = [np.array(p, dtype=float) * units for p in points]
    sums = likelihood_sums(frame, likelihood, columns, thetas)
    values = [-v / n + penalty * float(np.sum(t**2)) for t, (n, v, _) in zip(thetas, sums)]
    return sums[0][0], values


def bgnbd_objective(
    summary: DataFrame, points: list[list[float]], penalty: float = BGNBD_PENALTY
) -> tuple[float, list[float]]:
    """Customers, and the penalised mean negative log-likelihood at each (r, alpha, a, b)."""
    scale = 1.0 / max(summary.agg(F.max("T")).first()[0], 1)
    scaled = summary.select(
        "frequency", (F.col("recency") * scale).alias("recency"), (F.col("T") * scale).alias("T"),
        F.lit(1.0).alias("weight"),
    )
    units = np.array([1.0, scale, 1.0, 1.0])
    columns = ["frequency", "recency", "T", "weight"]
    return _objectives(scaled, bgnbd_log_likelihood, columns, points, units, penalty)


def gamma_gamma_objective(
    summary: DataFrame, points: list[list[float]], penalty: float = GAMMA_PENALTY
) -> tuple[float, list[float]]:
    """Repeat buyers, and the penalised mean negative log-likelihood at each (p, q, v)."""
    buyers = repeat_buyers(summary).filter(F.col("monetary_value") > 0)
    columns = ["frequency", "monetary_value", "weight"]
    weighted = buyers.withColumn("weight", F.lit(1.0))
    return _objectives(weighted, gamma_gamma_log_likelihood, columns, points, np.ones(3), penalty)


def _loglik_row(frame: DataFrame, n: float, value: float) -> DataFrame:
    return frame.sparkSession.createDataFrame(
        [(int(n), float(value))], "Customers long, LogLikelihood double"
    )


def prob_alive(model: BgNbd) -> Column:
    """Probability that the customer has not dropped out; 1 without repeat purchases."""
    x = F.col("frequency").cast("double")
    ratio = (model.alpha + F.col("T")) / (model.alpha + F.col("recency"))
    odds = F.lit(model.a) / (model.b + x - 1) * F.pow(ratio, model.r + x)
    return F.when(x > 0, 1 / (1 + odds)).otherwise(F.lit(1.0))


def _expected_while_alive(model: BgNbd, horizon, x, age) -> np.ndarray:
    """E[purchases within the horizon | alive now]; the Euler form is stable for all x.

    The formula divides by a - 1, a removable gap: at a = 1 the mean of both sides is taken.
    """

    def at(a: float) -> np.ndarray:
        b, r = model.b, model.r
        whole = model.alpha + age + horizon
        rest = (model.alpha + age) / whole
        series = hyp2f1(a + b - 1 - r, a - 1, a + b + x - 1, horizon / whole, rest)
        return (a + b + x - 1) / (a - 1) * (1 - rest ** (a - 1) * series)

    if abs(model.a - 1) > 1e-5:
        return at(model.a)
    return (at(1 + 2e-5) + at(1 - 2e-5)) / 2


def expected_purchases(model: BgNbd, horizon_days: float = 90) -> Column:
    """E[purchases within the horizon] given each customer's history."""

    @F.pandas_udf("double")
    def while_alive(x: pd.Series, age: pd.Series) -> pd.Series:
        return pd.Series(
            _expected_while_alive(model, horizon_days, x.to_numpy(float), age.to_numpy(float))
        )

    return while_alive(F.col("frequency"), F.col("T")) * prob_alive(model)


def expected_avg_spend(model: GammaGamma) -> Column:
    """Spend per purchase, shrunk towards the population mean; that mean for one-time buyers."""
    x = F.col("frequency").cast("double")
    weight = F.lit(model.p) * x / (model.p * x + model.q - 1)
    population = F.lit(model.p * model.v / (model.q - 1))
    return (1 - weight) * population + weight * F.col("monetary_value")


def clv_12m(
    purchases: BgNbd,
    spend: GammaGamma,
    months: int = HORIZON_MONTHS,
    discount: float = MONTHLY_DISCOUNT,
) -> Column:
    """Discounted value of the purchases expected in each of the next 30-day months."""

    @F.pandas_udf("double")
    def discounted(x: pd.Series, age: pd.Series) -> pd.Series:
        xs, ages = x.to_numpy(float), age.to_numpy(float)
        total, before = np.zeros(len(xs)), np.zeros(len(xs))
        for month in range(1, months + 1):
            upto = _expected_while_alive(purchases, MONTH_DAYS * month, xs, ages)
            total += (upto - before) / (1 + discount) ** month
            before = upto
        return pd.Series(total)

    return (
        discounted(F.col("frequency"), F.col("T"))
        * prob_alive(purchases)
        * expected_avg_spend(spend)
    )


def actual_spend(clean: DataFrame) -> DataFrame:
    return clean.groupBy("CustomerID").agg(F.sum("TotalPrice").alias("ActualSpend"))


def unstable_clv_count(scored: DataFrame) -> DataFrame:
    """One-time buyers whose modelled value is missing or negative."""
    value = number(F.col("CLV_12m"))
    return scored.filter(F.col("frequency") == 0).agg(
        F.count_if(value.isNull() | (value < 0)).alias("Unstable"),
        F.count(F.lit(1)).alias("OneTime"),
    )


def one_time_fallback(scored: DataFrame, spend: DataFrame) -> DataFrame:
    """One-time buyers get their historical spend; what is left below 0 becomes 0."""
    joined = scored.join(spend, "CustomerID", "left")
    value = F.when(F.col("frequency") == 0, F.col("ActualSpend").cast("double")).otherwise(
        number(F.col("CLV_12m"))
    )
    return joined.withColumn("CLV_12m", clip_lower(value, 0.0)).drop("ActualSpend")


def clv_tiers(valued: DataFrame, on_ties: str = "raise") -> DataFrame:
    """Add the value tier, cut at the median and the 80th percentile. Pass a stored table."""
    edges = inner_edges(valued, {"CLV_12m": TIER_CUTS}, on_ties)
    code = cut_at(number(F.col("CLV_12m")), edges["CLV_12m"])
    return valued.withColumn("CLV_Tier", label_of(code, TIERS))


def clv_tier_summary(valued: DataFrame) -> DataFrame:
    """Customers, mean and total value per tier, lowest tier first."""
    rank = F.array_position(F.array(*[F.lit(t) for t in TIERS]), F.col("CLV_Tier"))
    return (
        valued.filter(F.col("CLV_Tier").isNotNull())
        .groupBy("CLV_Tier")
        .agg(
            F.count("CLV_12m").alias("Customers"),
            F.avg("CLV_12m").alias("AvgCLV"),
            F.sum("CLV_12m").alias("TotalCLV"),
        )
        .orderBy(rank)
    )


def clv_scores(clean: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Fit both models and score every customer, stored; with the tables about the fits."""
    summary = store(fill_missing_spend(clv_summary_input(clean)), "clv-summary")
    purchases, purchase_table = fit_bgnbd(summary)
    spend, spend_table = fit_gamma_gamma(summary)
    scored = store(
        summary.withColumns(
            {
                "PredictedPurchases_90d": expected_purchases(purchases),
                "ProbAlive": prob_alive(purchases),
                "CLV_12m": clv_12m(purchases, spend),
            }
        ),
        "clv-scored",
    )
    return scored, {
        "purchase_coefficients": purchase_table,
        "spend_coefficients": spend_table,
        "frequency_monetary_corr": frequency_spend_correlation(summary),
        "unstable_clv": unstable_clv_count(scored),
    }


def clv_predictions(
    clean: DataFrame, on_ties: str = "raise", scored: DataFrame | None = None
) -> DataFrame:
    """Value every customer. ``clean`` should be a stored table; ``scored`` is that of
    ``clv_scores`` where it is at hand."""
    scored = clv_scores(clean)[0] if scored is None else scored
    valued = store(one_time_fallback(scored, actual_spend(clean)), "clv-valued")
    return clv_tiers(valued, on_ties)
