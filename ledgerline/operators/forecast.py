"""Weekly forecasts of many series at once, with an honest holdout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.model import Columns, base_currency_only
from ledgerline.operators.calendar import FESTIVALS, weekly_revenue
from ledgerline.operators.joins import outer_merge

# Holdout length, seasonal shape, interval and the band of the fallback.
HOLDOUT_WEEKS = 12
FOURIER_PAIRS = 10
CHANGE_POINTS = 25
CHANGE_RANGE = 0.8
INTERVAL = 0.80
SEASON_WEEKS = 52
FALLBACK_BAND = 0.10
YEAR_WEEKS = 365.25 / 7
BEND_SCALE = 0.05
# Futures that an interval is made of, and their seed.
PATHS = 1_000
SEED = 42

SCHEMA = "series string, week date, forecast double, lower double, upper double, form string"


@dataclass(frozen=True)
class Holdout:
    """The last weeks of the data are kept from the fit."""

    first_week: pd.Timestamp
    last_week: pd.Timestamp

    @property
    def weeks(self) -> int:
        return (self.last_week - self.first_week).days // 7 + 1


def weekly_series(
    orders: DataFrame, c: Columns = Columns(), by: str | None = None, drop_partial_last_week: bool = False
) -> DataFrame:
    """(series, week, revenue) on Mondays; one series ``all`` unless ``by`` names a key.

    With ``drop_partial_last_week`` the last week goes if the data ends before its Sunday.
    """
    key = F.col(by).cast("string") if by else F.lit("all")
    weekly = weekly_revenue(orders, c, [key.alias("series")])
    if drop_partial_last_week:
        last_day = base_currency_only(orders, c).agg(F.max(c.day).alias("d")).scalar()
        weekly = weekly.where(F.date_add("week", 6) <= last_day)
    return weekly


def holdout(series: DataFrame, weeks: int = HOLDOUT_WEEKS) -> Holdout:
    """The last ``weeks`` Monday weeks of the whole data set, the same for every series."""
    last = pd.Timestamp(series.agg(F.max("week").alias("last")).first()["last"])
    return Holdout(last - pd.Timedelta(weeks=weeks - 1), last)


def split_holdout(series: DataFrame, kept_back: Holdout) -> tuple[DataFrame, DataFrame]:
    border = F.lit(str(kept_back.first_week.date())).cast("date")
    return series.where(F.col("week") < border), series.where(F.col("week") >= border)


def forecast_series(
    train: DataFrame,
    kept_back: Holdout,
    method: str = "seasonal",
    festivals: Mapping[str, Sequence[str]] | None = None,
    bends_from: int = 2 * CHANGE_POINTS + 1,
    season_from: int = 2 * SEASON_WEEKS,
) -> DataFrame:
    """Fit every series on its own and predict its past weeks and the holdout.

    A series is one row per week, so a group is as long as the calendar and no longer. The trend bends in
    series of at least ``bends_from`` weeks with a value, and smoothing has a season in series of at least
    ``season_from`` weeks; ``form`` says which form was fitted. A series without a single value gets rows
    without a forecast.
    """
    festivals = dict(FESTIVALS if festivals is None else festivals)
    last = kept_back.last_week
    fit, least = {"seasonal": (_seasonal, bends_from), "holt_winters": (_holt_winters, season_from)}[method]

    def predict(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.assign(week=pd.to_datetime(frame["week"]), revenue=frame["revenue"].astype(float))
        name, first = frame["series"].iloc[0], frame["week"].min()
        frame = frame.dropna(subset=["revenue"]).sort_values("week")
        if frame.empty:
            grid = pd.date_range(first, last, freq="W-MON")
            blank = pd.DataFrame({"series": name, "week": grid.date})
            return blank.assign(forecast=np.nan, lower=np.nan, upper=np.nan, form="no value")
        grid = pd.date_range(frame["week"].iloc[0], last, freq="W-MON")
        known = frame.set_index("week")["revenue"].reindex(grid)
        trained = int(grid.searchsorted(frame["week"].iloc[-1])) + 1
        middle, lower, upper, form = fit(grid, known.to_numpy(dtype=float), trained, festivals, least)
        return pd.DataFrame(
            {
                "series": name,
                "week": grid.date,
                "forecast": middle,
                "lower": lower,
                "upper": upper,
                "form": form,
            }
        )

    return train.select("series", "week", "revenue").groupBy("series").applyInPandas(predict, SCHEMA)


def _festival_columns(grid: pd.DatetimeIndex, festivals: Mapping[str, Sequence[str]]) -> np.ndarray:
    """1 in the weeks that the day before, the day or the day after a festival falls into."""
    columns = []
    for days in festivals.values():
        touched = set()
        for day in pd.to_datetime(list(days)):
            for shift in (-1, 0, 1):
                moved = day + pd.Timedelta(days=shift)
                touched.add(moved - pd.Timedelta(days=moved.weekday()))
        columns.append(np.array([float(w in touched) for w in grid]))
    return np.column_stack(columns) if columns else np.zeros((len(grid), 0))


def sparse_ridge(gram: np.ndarray, target: np.ndarray, ridge: np.ndarray, lasso: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Weights of least squares with a squared and an absolute penalty on each, by coordinate descent.

    ``gram`` and ``target`` are X'X and X'y. A weight whose pull is below its absolute penalty is exactly zero.
    """
    weights = np.linalg.solve(gram + np.diag(ridge), target)
    scale = np.diag(gram) + ridge
    pull = target - gram @ weights
    for _ in range(rounds):
        moved = 0.0
        for j in range(len(weights)):
            if scale[j] <= 0:
                continue
            free = pull[j] + gram[j, j] * weights[j]
            new = np.sign(free) * max(abs(free) - lasso[j], 0.0) / scale[j]
            step = new - weights[j]
            if step:
                pull -= gram[:, j] * step
                weights[j] = new
                moved = max(moved, abs(step) * np.sqrt(scale[j]))
        if moved < 1e-7:
            break
    return weights


def future_spread(bends: np.ndarray, errors: np.ndarray, ahead: int, rate: float, step: float, paths: int = PATHS) -> tuple[np.ndarray, np.ndarray]:
    """(below, above): how far the interval reaches in each of the weeks ahead, never less than in the week before.

    On each path the trend bends in a week with probability ``rate``, by a Laplace draw as large as the fitted
    bends are on average, and every week adds an error of the past.
    """
    draw = np.random.default_rng(SEED)
    size = np.abs(bends).mean() if len(bends) else 0.0
    slopes = np.where(draw.random((paths, ahead)) < rate, draw.laplace(0.0, size, (paths, ahead)) if size else 0.0, 0.0)
    drift = np.cumsum(np.cumsum(slopes, axis=1) * step, axis=1)
    noise = draw.choice(errors, size=(paths, ahead))
    tail = (1 - INTERVAL) / 2
    low, high = np.quantile(drift + noise, [tail, 1 - tail], axis=0)
    return np.maximum.accumulate(np.maximum(-low, 0.0)), np.maximum.accumulate(np.maximum(high, 0.0))


def _seasonal(grid, known, trained, festivals, bends_from):
    """Regression on a trend with few bends, yearly harmonics and festival weeks; an interval of simulated futures."""
    observed = np.flatnonzero(~np.isnan(known[:trained]))
    y = known[observed]
    scale = np.abs(y).max() or 1.0
    time = np.arange(len(grid)) / max(trained - 1, 1)
    bends = np.linspace(0, CHANGE_RANGE, CHANGE_POINTS + 1)[1:] if len(y) >= bends_from else np.zeros(0)
    phase = 2 * np.pi * (grid.dayofyear.to_numpy() / 7 + grid.year.to_numpy() * YEAR_WEEKS) / YEAR_WEEKS
    pairs = np.arange(1, FOURIER_PAIRS + 1)
    design = [
        np.ones((len(grid), 1)),
        time[:, None],
        np.maximum(time[:, None] - bends, 0),
        np.sin(phase[:, None] * pairs),
        np.cos(phase[:, None] * pairs),
        _festival_columns(grid, festivals),
    ]
    penalties = [1e-9, 1e-3, 1e-6, 0.1, 0.1, 0.5]
    ridge = np.concatenate([np.full(block.shape[1], p) for block, p in zip(design, penalties)])
    x = np.hstack(design)
    seen, aim = x[observed], y / scale
    gram, target = seen.T @ seen, seen.T @ aim
    # A bend costs as much as under a Laplace prior of this scale, beside errors as large as a free trend leaves.
    free = np.linalg.solve(gram + np.diag(ridge), target)
    lasso = np.zeros(x.shape[1])
    lasso[2 : 2 + len(bends)] = max(float(np.var(aim - seen @ free)), 1e-8) / BEND_SCALE
    weights = sparse_ridge(gram, target, ridge, lasso)
    middle = x @ weights * scale
    errors = y - middle[observed]
    tail = (1 - INTERVAL) / 2
    low, high = np.quantile(errors, [tail, 1 - tail])
    below, above = np.full(len(grid), max(-low, 0.0)), np.full(len(grid), max(high, 0.0))
    if len(grid) > trained:
        step = time[1] - time[0] if len(time) > 1 else 0.0
        # As often as the past could bend.
        rate = min(1.0, CHANGE_POINTS / max(CHANGE_RANGE * trained, 1)) if len(bends) else 0.0
        down, up = future_spread(weights[2 : 2 + len(bends)] * scale, errors, len(grid) - trained, rate, step)
        below[trained:], above[trained:] = np.maximum(down, below[0]), np.maximum(up, above[0])
    form = "bending trend" if len(bends) else "straight trend"
    return middle, middle - below, middle + above, form


def _holt_winters(grid, known, trained, festivals, season_from):
    """Additive level, trend and season, smoothing weights by least squared error over a small grid."""
    y = pd.Series(known[:trained]).interpolate(limit_direction="both").to_numpy()
    season = SEASON_WEEKS if len(y) >= max(season_from, SEASON_WEEKS + 1) else 1
    alpha, beta, gamma = (
        a.ravel()
        for a in np.meshgrid([0.05, 0.1, 0.2, 0.4, 0.7], [0.0, 0.01, 0.05, 0.2], [0.05, 0.1, 0.3] if season > 1 else [0.0])
    )
    start = y[:season].mean()
    slope = (y[season : 2 * season].mean() - start) / season if season > 1 else 0.0
    level = np.full(alpha.shape, start)
    trend = np.full(alpha.shape, slope)
    swings = np.tile((y[:season] - start)[:, None], (1, len(alpha))) if season > 1 else np.zeros((1, len(alpha)))
    fitted = np.zeros((len(y), len(alpha)))
    for t, value in enumerate(y):
        swing = swings[t % season]
        fitted[t] = level + trend + swing
        above = value - swing
        moved = alpha * above + (1 - alpha) * (level + trend)
        trend = beta * (moved - level) + (1 - beta) * trend
        swings[t % season] = gamma * (value - moved) + (1 - gamma) * swing
        level = moved
    best = int(np.argmin(((fitted - y[:, None]) ** 2).sum(axis=0)))
    ahead = np.arange(1, len(grid) - len(y) + 1)
    future = level[best] + ahead * trend[best] + swings[(len(y) + ahead - 1) % season, best]
    middle = np.concatenate([fitted[:, best], future])
    width = np.concatenate([np.zeros(len(y)), np.abs(future) * FALLBACK_BAND])
    return middle, middle - width, middle + width, "season" if season > 1 else "no season"


def holdout_errors(actual: DataFrame, forecast: DataFrame, by: Sequence[str] = ("series",)) -> DataFrame:
    """Mean absolute and percentage error per series over weeks that have both values.

    A series without a forecast, say one that begins in the holdout, is listed with 0 weeks.
    """
    both = actual.join(forecast, [*by, "week"], "left")
    miss = F.abs(F.col("revenue") - F.col("forecast"))
    return both.groupBy(*by).agg(
        F.count(miss).alias("weeks"),
        F.avg(miss).alias("mae"),
        (F.avg(miss / F.greatest(F.col("revenue"), F.lit(1.0))) * 100).alias("mape"),
    )


def forecast_table(series: DataFrame, forecast: DataFrame, kept_back: Holdout) -> DataFrame:
    """Actual and forecast side by side; both stand on Mondays, so holdout weeks match."""
    border = F.lit(str(kept_back.first_week.date())).cast("date")
    return outer_merge(series, forecast, ["series", "week"]).select(
        "series",
        "week",
        F.bround("revenue", 2).alias("actual_revenue"),
        *[F.bround(c, 2).alias(c) for c in ("forecast", "lower", "upper")],
        (F.col("week") >= border).alias("is_holdout_forecast"),
    )
