"""The numeric helper behind the additive forecaster: fit one series, predict its days.

The model is the published additive one: y = trend * (1 + multiplicative terms) + additive
terms + noise, with a piecewise linear or logistic trend, Fourier terms for the year and
the week, and one effect per holiday day. Slope changes carry a Laplace prior, everything
else a normal one. The fit is a damped Gauss-Newton search for the posterior mode in which
the Laplace prior is replaced by its quadratic bound at the current point.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# --- Fixed values: published defaults of the model ---------------------------------------
YEAR_DAYS, YEAR_ORDER = 365.25, 10
WEEK_DAYS, WEEK_ORDER = 7.0, 3
BASE_SCALE = 5.0
EFFECT_SCALE = 10.0
NOISE_SCALE = 0.5
# -----------------------------------------------------------------------------------------
MAX_STEPS = 25
TOLERANCE = 1e-6
SMALLEST_CHANGE = 1e-5


@dataclass(frozen=True)
class Seasons:
    """Whether yearly and weekly terms are fitted: ``auto``, ``on`` or ``off``.

    ``auto`` is the published rule: a training span of two periods or more.
    """

    yearly: str = "auto"
    weekly: str = "auto"

    def __post_init__(self):
        for value in (self.yearly, self.weekly):
            if value not in ("auto", "on", "off"):
                raise ValueError(f"a season is auto, on or off, not {value!r}")

    @staticmethod
    def wanted(setting: str, span: float, least: float) -> bool:
        return setting == "on" or (setting == "auto" and span >= least)


@dataclass
class Settings:
    """One parameter set."""

    growth: str = "linear"
    changepoint_prior_scale: float = 0.05
    n_changepoints: int = 25
    seasonality_mode: str = "additive"
    changepoint_range: float = 0.8
    interval_width: float = 0.8


def fourier(days: np.ndarray, period: float, order: int) -> np.ndarray:
    angles = 2.0 * np.pi * np.outer(days, np.arange(1, order + 1)) / period
    return np.hstack([np.cos(angles), np.sin(angles)])


def changepoints(t_train: np.ndarray, count: int, share: float) -> np.ndarray:
    """Times of possible slope changes, evenly spread over the first part of the history."""
    usable = int(np.floor(len(t_train) * share))
    count = min(count, usable - 1)
    if count <= 0:
        return np.empty(0)
    places = np.linspace(0, usable - 1, count + 1).round().astype(int)[1:]
    return t_train[places]


def trend_basis(t: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Intercept, slope, and one hinge per changepoint."""
    hinges = np.maximum(0.0, t[:, None] - points[None, :])
    return np.hstack([np.ones((len(t), 1)), t[:, None], hinges])


def _trend(z: np.ndarray, logistic: bool, cap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trend above the floor and its derivative, from the linear predictor."""
    if not logistic:
        return z, np.ones_like(z)
    share = 1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0)))
    return cap * share, cap * share * (1.0 - share)


def posterior_mode(
    y: np.ndarray,
    basis: np.ndarray,
    terms: np.ndarray,
    multiplicative: bool,
    logistic: bool,
    cap: np.ndarray,
    tau: float,
) -> np.ndarray:
    """Coefficients of the trend basis, then of the terms."""
    n, n_trend, n_terms = len(y), basis.shape[1], terms.shape[1]
    theta = np.zeros(n_trend + n_terms)
    edge = max(1, n // 20)
    first, last = y[:edge].mean(), y[-edge:].mean()
    if logistic:
        ends = np.clip(np.array([first, last]) / cap[[0, -1]], 0.02, 0.98)
        first, last = np.log(ends / (1.0 - ends))
    theta[0], theta[1] = first, last - first
    precision = np.full(n_trend + n_terms, 1.0 / EFFECT_SCALE**2)
    precision[:2] = 1.0 / BASE_SCALE**2

    def evaluate(point):
        trend, slope = _trend(basis @ point[:n_trend], logistic, cap)
        effect = terms @ point[n_trend:]
        fitted = trend * (1.0 + effect) if multiplicative else trend + effect
        residual = y - fitted
        changes = np.abs(point[2:n_trend])
        rss = residual @ residual
        # mode of the noise scale under its half-normal prior, given the residuals
        s = NOISE_SCALE**2
        noise = s * (-n + np.sqrt(n * n + 4.0 * rss / s)) / 2.0
        noise = max(noise, 1e-10)
        rest = np.concatenate([point[:2], point[n_trend:]])
        rest_precision = np.concatenate([precision[:2], precision[n_trend:]])
        loss = (
            0.5 * rss / noise + 0.5 * n * np.log(noise) + 0.5 * noise / s
            + changes.sum() / tau + 0.5 * (rest_precision * rest) @ rest
        )
        return trend, slope, effect, residual, noise, loss

    trend, slope, effect, residual, noise, loss = evaluate(theta)
    constant = not (multiplicative or logistic)
    jacobian = np.hstack([basis, terms]) if constant else None
    gram = jacobian.T @ jacobian if constant else None
    for _ in range(MAX_STEPS):
        if not constant:
            gain = slope * (1.0 + effect) if multiplicative else slope
            columns = trend[:, None] * terms if multiplicative else terms
            jacobian = np.hstack([gain[:, None] * basis, columns])
            gram = jacobian.T @ jacobian
        precision[2:n_trend] = 1.0 / (tau * np.maximum(np.abs(theta[2:n_trend]), SMALLEST_CHANGE))
        system = gram / noise + np.diag(precision)
        pull = jacobian.T @ residual / noise - precision * theta
        step = np.linalg.solve(system, pull)
        for share in (1.0, 0.5, 0.25, 0.1, 0.02):
            candidate = theta + share * step
            state = evaluate(candidate)
            if state[-1] <= loss:
                break
        else:
            break
        gained = loss - state[-1]
        theta = candidate
        trend, slope, effect, residual, noise, loss = state
        if gained < TOLERANCE * max(1.0, abs(loss)):
            break
    return theta


def fit_predict(
    days: np.ndarray,
    y: np.ndarray,
    is_train: np.ndarray,
    effects: np.ndarray,
    settings: Settings,
    cap: float | None = None,
    floor: float | None = None,
    regressor: np.ndarray | None = None,
    seasons: Seasons = Seasons(),
) -> dict[str, np.ndarray]:
    """Fit on the training days and return yhat, its band and its parts for all days.

    ``days`` are day numbers, ``effects`` a 0/1 matrix with one column per holiday effect.
    A series without room between floor and cap (all values zero) gets a linear trend.
    """
    logistic = settings.growth == "logistic"
    if logistic and (cap is None or floor is None):
        raise ValueError("logistic growth needs a cap and a floor")
    logistic = logistic and cap > floor
    multiplicative = settings.seasonality_mode == "multiplicative"
    train_days = days[is_train]
    start, span = train_days[0], max(train_days[-1] - train_days[0], 1)
    t = (days - start) / span
    low = float(floor) if logistic else 0.0
    scale = float(np.abs(y[is_train] - low).max()) or 1.0
    ys = (y[is_train] - low) / scale
    top = np.full(len(days), (float(cap) - low) / scale if logistic else 0.0)

    blocks = {}
    if seasons.wanted(seasons.yearly, span, 2 * 365):
        blocks["yearly"] = fourier(days, YEAR_DAYS, YEAR_ORDER)
    if seasons.wanted(seasons.weekly, span, 14):
        blocks["weekly"] = fourier(days, WEEK_DAYS, WEEK_ORDER)
    if effects.shape[1]:
        blocks["holidays"] = effects
    if regressor is not None:
        known = regressor[is_train]
        spread = known.std()
        if spread > 0:
            blocks["regressor"] = ((regressor - known.mean()) / spread)[:, None]
    terms = np.hstack([*blocks.values(), np.empty((len(days), 0))])
    points = changepoints(t[is_train], settings.n_changepoints, settings.changepoint_range)
    basis = trend_basis(t, points)
    theta = posterior_mode(
        ys, basis[is_train], terms[is_train], multiplicative, logistic, top[is_train],
        settings.changepoint_prior_scale,
    )

    trend, _ = _trend(basis @ theta[: basis.shape[1]], logistic, top)
    weight = trend if multiplicative else np.ones_like(trend)
    parts, place = {}, basis.shape[1]
    for name, block in blocks.items():
        width = block.shape[1]
        parts[name] = weight * (block @ theta[place : place + width]) * scale
        place += width
    out = {"trend": trend * scale + low}
    for name in ("weekly", "yearly", "holidays", "regressor"):
        out[name] = parts.get(name, np.zeros(len(days)))
    out["yhat"] = out["trend"] + sum(parts.values())
    errors = y[is_train] - out["yhat"][is_train]
    outside = (1.0 - settings.interval_width) / 2.0
    lower, upper = np.quantile(errors, [outside, 1.0 - outside])
    out["yhat_lower"], out["yhat_upper"] = out["yhat"] + lower, out["yhat"] + upper
    return out
