"""Per-series unit-root test and ARIMA forecasts on chunks of series.

A series is cut into chunks of rows that carry the values before them (:mod:`opsight.operators.series`); each
chunk gives small sums, Spark adds them for each series, and only the solution of the small normal
equations works on one row for each series. No task holds a series.

ARIMA starts from two regressions (Hannan and Rissanen: a long autoregression gives residuals, then the series
is regressed on its own lags and on these), with roots inside the unit circle reflected outside. Damped
Gauss-Newton steps then minimise the conditional sum of squares. The residuals and their derivatives
follow a linear recurrence, so a chunk is an affine map of the state at its start: every round composes the
chunks' maps to their starting states and adds up the chunks' sums. Steps to a root on or inside the unit
circle, or to a larger sum of squares, are rejected.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsight.functions.distributions import normal_cdf
from opsight.operators.ranks import match, written
from opsight.operators.series import CHUNK_ROWS, chunks, numbered, sum_arrays

# MacKinnon (1994) response-surface p-value for the ADF test with
# a constant and one variable (small-p, large-p polynomials and their limits).
ADF_TAU_STAR_C = -1.61
ADF_TAU_MIN_C = -18.83
ADF_TAU_MAX_C = 2.74
ADF_SMALLP_C = (2.1659, 1.4412, 0.038269)
ADF_LARGEP_C = (1.7339, 0.93202, -0.12745, -0.010368)
# MacKinnon (2010) critical values, constant, one variable:
# b0 + b1/T + b2/T^2 + b3/T^3 for the 1 %, 5 % and 10 % levels.
ADF_CRIT_C = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}
Z_975 = 1.959963984540054


def adf_pvalue(stat: float) -> float:
    if stat > ADF_TAU_MAX_C:
        return 1.0
    if stat < ADF_TAU_MIN_C:
        return 0.0
    coef = ADF_SMALLP_C if stat <= ADF_TAU_STAR_C else ADF_LARGEP_C
    return normal_cdf(sum(c * stat ** i for i, c in enumerate(coef)))


def adf_critical_values(nobs: int) -> dict[str, float]:
    return {k: b[0] + b[1] / nobs + b[2] / nobs ** 2 + b[3] / nobs ** 3 for k, b in ADF_CRIT_C.items()}


# ---------------------------------------------------------------- Gram sums
def _square(flat: Sequence[float]) -> np.ndarray:
    """The symmetric matrix of :func:`gram_sums`; column 0 is the target."""
    size = int((math.isqrt(8 * len(flat) + 1) - 1) / 2)
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = flat
    return full + np.triu(full, 1).T


def _solve(gram: np.ndarray, chosen: Sequence[int]) -> tuple[np.ndarray, float, np.ndarray]:
    """Coefficients of target 0 on the chosen columns, residual sum of squares, inverse normal matrix."""
    scale = np.sqrt(np.maximum(np.diag(gram)[list(chosen)], 1e-300))
    normal = gram[np.ix_(chosen, chosen)] / np.outer(scale, scale)
    inverse = np.linalg.pinv(normal, rcond=1e-13, hermitian=True) / np.outer(scale, scale)
    beta = inverse @ gram[list(chosen), 0]
    return beta, max(float(gram[0, 0] - beta @ gram[list(chosen), 0]), 0.0), inverse


# ---------------------------------------------------------------- ADF
def _longest_lag(n: int, most: int | None) -> int:
    """The usual longest lag for a series of ``n`` values, ``most`` at most; negative when it is too short."""
    if n < 6:
        return -1
    usual = min(math.ceil(12.0 * (n / 100.0) ** 0.25), n // 2 - 2)
    return usual if most is None else min(usual, most)


def _lags(w: np.ndarray, rows: np.ndarray, count: int, width: int) -> np.ndarray:
    """The ``count`` values before each of ``rows``, in ``width`` columns."""
    out = np.zeros((len(rows), width))
    for k in range(1, count + 1):
        out[:, k - 1] = w[rows - k]
    return out


def _adf_design(x: np.ndarray, rows: np.ndarray, lags: int, width: int) -> np.ndarray:
    """Change, level before, 1 and the lagged changes at ``rows`` of ``x``."""
    dx = np.diff(x, prepend=np.nan)
    return np.column_stack([dx[rows], x[rows - 1], np.ones(len(rows)), _lags(dx, rows, lags, width)])


def _adf_sums(most: int | None, width: int, least: int):
    @F.pandas_udf("array<double>")
    def run(n: pd.Series, first: pd.Series, lent: pd.Series, x: pd.Series, shift: pd.Series) -> pd.Series:
        out = []
        for size, start, before, values, mean in zip(n, first, lent, x, shift):
            lag = _longest_lag(int(size), most)
            values = np.asarray(values, float) - mean
            rows = np.arange(max(before, lag + 2 - start), len(values))  # places from lag + 2 on
            m = _adf_design(values, rows[rows > 0], lag, width) if lag >= least else np.zeros((0, 3 + width))
            edge = np.zeros(2 * width + 4)  # the first values, for the rows that only shorter lags have
            if start == 1:
                head = values[:len(edge)]
                edge[:len(head)] = head
            out.append([*(m.T @ m)[np.triu_indices(3 + width)], float(len(m)), *edge])
        return pd.Series(out)
    return run


_ADF_RESULT = T.StructType([
    T.StructField("adf_statistic", T.DoubleType()), T.StructField("p_value", T.DoubleType()),
    T.StructField("used_lag", T.IntegerType()), T.StructField("nobs", T.IntegerType()),
    *[T.StructField(f"crit_{k}pct", T.DoubleType()) for k in (1, 5, 10)], T.StructField("stationary", T.BooleanType())])


def _adf_result(most: int | None, width: int, least: int):
    entries = (3 + width) * (4 + width) // 2

    @F.pandas_udf(_ADF_RESULT)
    def run(sums: pd.Series, n: pd.Series) -> pd.DataFrame:
        rows = []
        for flat, size in zip(sums, n):
            longest = _longest_lag(int(size), most)
            if longest < least:
                rows.append((None,) * 8)
                continue
            common, nobs, edge = _square(flat[:entries]), float(flat[entries]), np.asarray(flat[entries + 1:])
            best = (math.inf, 0)
            for lag in range(least, longest + 1):  # all lengths on the sample of the longest
                _, ssr, _ = _solve(common, [1, 2, *range(3, 3 + lag)])
                if ssr > 0 and nobs > 0:
                    best = min(best, (nobs * math.log(ssr / nobs) + 2 * (lag + 2), lag))
            lag = best[1]
            extra = _adf_design(edge, np.arange(lag + 1, longest + 1), lag, width)  # the best on its own sample
            gram, nobs = common + extra.T @ extra, int(nobs) + len(extra)
            chosen, stat = [1, 2, *range(3, 3 + lag)], math.nan
            free = nobs - len(chosen)
            if free > 0:
                beta, ssr, inverse = _solve(gram, chosen)
                spread = ssr / free * inverse[0, 0]
                stat = float(beta[0] / math.sqrt(spread)) if spread > 0 else math.nan
            crit = adf_critical_values(nobs)
            known = not math.isnan(stat)
            p = adf_pvalue(stat) if known else None
            rows.append((stat if known else None, p, lag, nobs, crit["1%"], crit["5%"], crit["10%"], p < 0.05 if known else None))
        out = pd.DataFrame(rows, columns=_ADF_RESULT.names)
        return out.astype({"used_lag": "Int32", "nobs": "Int32", "stationary": "boolean"})
    return run


def adf(df: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value", maxlag: int | None = None,
        lag: int | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant for each series (J3); lag length by AIC up to ``maxlag``.

    All lengths are compared on the sample of the longest, and the best is refitted on its own. With
    ``maxlag=0`` this is the plain Dickey-Fuller regression; ``lag`` fixes the length. Series of fewer than six values, or
    too short for a fixed length, have NULLs, constant ones no statistic. The sums of all rows come from one pass; the refit adds the few rows that the longest lag leaves out.
    """
    keys = list(keys)
    maxlag, least = (maxlag, 0) if lag is None else (lag, lag)
    values = df.filter(F.col(value).isNotNull()).select(*keys, ts, F.col(value).cast("double").alias(value))
    about = written(values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("shift")), "adf")
    width = max(0, _longest_lag(int(about.agg(F.max("n")).first()[0] or 0), maxlag))
    table = chunks(numbered(values, keys, ts), keys, value, width + 2, chunk_rows)
    parts = match(table, about.select(*keys, "shift"), keys).select(
        *keys, _adf_sums(maxlag, width, least)("n", "first", "lent", "x", "shift").alias("sums"))
    sums = match(sum_arrays(parts, keys, "sums"), about.select(*keys, "n"), keys)
    return sums.select(*keys, _adf_result(maxlag, width, least)("sums", "n").alias("r")).select(*keys, "r.*")


# ---------------------------------------------------------------- ARIMA
def reflected(coefs: np.ndarray) -> np.ndarray:
    """Coefficients c of 1 - c1 z - c2 z^2 ... with the roots inside the unit circle reflected to the outside."""
    if not np.any(coefs):
        return coefs
    roots = np.roots(np.r_[-coefs[::-1], 1.0])
    size = np.abs(roots)
    roots = np.where(size < 1, roots / np.maximum(size, 1e-8) ** 2, roots)
    roots = roots * np.maximum(1.0, ROOT / np.abs(roots))
    poly = np.ones(1)
    for r in roots:
        poly = np.convolve(poly, [1.0, -1.0 / r])
    out = np.zeros(len(coefs))
    out[:len(poly) - 1] = -poly.real[1:]
    return out


def _outside(coefs: np.ndarray) -> bool:
    """Whether all roots of 1 - c1 z - ... lie outside the unit circle."""
    return not np.any(coefs) or float(np.abs(np.roots(np.r_[-coefs[::-1], 1.0])).min()) > ROOT - 1e-9


class _Model:
    """Sizes and per-chunk sums of an ARIMA order; parameters are (phi, theta, constant if d = 0)."""

    def __init__(self, order: tuple[int, int, int], long_lags: int):
        self.p, self.d, self.q = order
        self.constant = int(self.d == 0)
        self.size = self.p + self.q + self.constant
        self.state = 1 + self.size  # a residual and its derivatives
        self.depth = max(self.q, 1)
        self.long = long_lags
        self.lent = self.d + max(long_lags + self.q, self.p) + 1

    def lag(self, n: int) -> int:
        """Length of the long autoregression for a series of ``n`` values; 0 if the series is too short to fit."""
        lag = min(self.long, max(1, (n - self.d) // 4))
        return lag if n - self.d - lag - max(self.p, self.q) >= self.size + 2 else 0

    def rows(self, w: np.ndarray, first: int, lent: int, after: int) -> np.ndarray:
        """The chunk's own rows of the differences ``w`` whose place is beyond ``after``; ``first`` is x's place."""
        return np.arange(max(lent - self.d, after + 1 - first - self.d, 0), len(w))

    def long_sums(self, n, first, lent, x) -> np.ndarray:
        lag = self.lag(n)
        if not lag:
            return np.zeros((2 + self.long) * (3 + self.long) // 2)
        w = np.diff(x, self.d)
        rows = self.rows(w, first, lent, self.d + lag)
        m = np.column_stack([w[rows], _lags(w, rows, lag, self.long), np.full(len(rows), float(self.constant))])
        return (m.T @ m)[np.triu_indices(2 + self.long)]

    def start_sums(self, n, first, lent, x, coefs) -> np.ndarray:
        lag, width = self.lag(n), 1 + self.p + self.q + 1
        if not lag:
            return np.zeros(width * (width + 1) // 2)
        w = np.diff(x, self.d)
        known = np.arange(max(lag, self.d + lag + 1 - first - self.d), len(w))
        e = np.zeros(len(w))
        e[known] = w[known] - _lags(w, known, lag, self.long) @ np.asarray(coefs[:self.long]) - self.constant * coefs[self.long]
        rows = self.rows(w, first, lent, self.d + lag + max(self.p, self.q))
        m = np.column_stack([w[rows], _lags(w, rows, self.p, self.p), _lags(e, rows, self.q, self.q), np.full(len(rows), float(self.constant))])
        return (m.T @ m)[np.triu_indices(width)]

    def start(self, gram: np.ndarray) -> np.ndarray:
        beta, _, _ = _solve(_square(gram), range(1, 2 + self.p + self.q))
        return np.r_[reflected(beta[:self.p]), -reflected(-beta[self.p:self.p + self.q]), beta[self.p + self.q:][:self.constant]]

    def valid(self, params: np.ndarray) -> bool:
        return _outside(params[:self.p]) and _outside(-params[self.p:self.p + self.q])

    def run(self, first, lent, x, candidates: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Residuals and derivatives of a chunk, shape (rows, candidates, state), and the state at its end, from the
        one at its start, shape (candidates, depth, state)."""
        w = np.diff(x, self.d)
        rows = self.rows(w, first, lent, self.d + self.p)
        phi, theta, const = np.split(candidates, [self.p, self.p + self.q], axis=1)
        lags = _lags(w, rows, self.p, self.p)
        out = np.zeros((len(rows), len(candidates), self.state))
        out[:, :, 0] = w[rows][:, None] - lags @ phi.T - (const[:, 0] if self.constant else 0.0)
        out[:, :, 1:1 + self.p] = -lags[:, None, :]
        if self.constant:
            out[:, :, -1] = -1.0
        of_theta = slice(1 + self.p, 1 + self.p + self.q)
        state = state.copy()
        if self.q:
            weights = theta[:, :, None]
            for t in range(len(rows)):
                y = out[t]
                y -= (weights * state).sum(axis=1)
                y[:, of_theta] -= state[:, :, 0]
                state[:, 1:] = state[:, :-1].copy()
                state[:, 0] = y
        return out, state

    def steps_in(self, first: int, lent: int, length: int) -> int:
        return len(self.rows(np.empty(length - self.d), first, lent, self.d + self.p))

    def compose(self, candidates: np.ndarray, chunk_rows: list[tuple[int, np.ndarray]]) -> list[np.ndarray]:
        """The state at the start of each chunk, and after the last, from each chunk's rows and its end state from zero."""
        m, q = self.state, self.depth
        maps = []
        for c in candidates:
            full = np.eye(m * q, k=-m)
            full[:m] = 0.0
            for j in range(self.q):
                full[:m, j * m:(j + 1) * m] -= c[self.p + j] * np.eye(m)
                full[1 + self.p + j, j * m] -= 1.0
            maps.append(full)
        states = [np.zeros((len(candidates), q, m))]
        for count, end in chunk_rows:
            moved = np.stack([(np.linalg.matrix_power(a, count) @ s.ravel()).reshape(q, m) for a, s in zip(maps, states[-1])])
            states.append(moved + end)
        return states


# Shares of a Gauss-Newton step that a round tries at once.
STEPS = (1.0, 0.5, 0.2, 0.05, 0.01)
ROOT = 1.001  # smallest modulus of a root
ROUNDS = 15
TOLERANCE = 1e-9  # relative gain in the sum of squares below which a series is done


def _residual_pass(model: _Model, table: DataFrame, state: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``sums`` of each series' candidates, and the chunks' starting states (chunk -1: the state after the last)."""
    def shaped(flat) -> np.ndarray:
        return np.asarray(flat, float).reshape(-1, model.size)

    @F.pandas_udf("array<double>")
    def ends(first: pd.Series, lent: pd.Series, x: pd.Series, tried: pd.Series) -> pd.Series:
        out = []
        for f, b, v, c in zip(first, lent, x, tried):
            c = shaped(c)
            out.append(model.run(int(f), int(b), np.asarray(v, float), c, np.zeros((len(c), model.depth, model.state)))[1].ravel())
        return pd.Series(out)

    @F.pandas_udf("array<struct<chunk:bigint,state:array<double>>>")
    def starts(tried: pd.Series, parts: pd.Series) -> pd.Series:
        out = []
        for c, own in zip(tried, parts):
            c = shaped(c)
            found = model.compose(c, [(int(r["count"]), np.reshape(r["end"], (len(c), model.depth, model.state))) for r in own])
            out.append([(int(k), s.ravel().tolist()) for k, s in zip([*[r["chunk"] for r in own], -1], found)])
        return pd.Series(out)

    @F.pandas_udf("array<double>")
    def sums(first: pd.Series, lent: pd.Series, x: pd.Series, tried: pd.Series, begin: pd.Series) -> pd.Series:
        out, upper = [], np.triu_indices(model.state)
        for f, b, v, c, s in zip(first, lent, x, tried, begin):
            c = shaped(c)
            y, _ = model.run(int(f), int(b), np.asarray(v, float), c, np.reshape(s, (len(c), model.depth, model.state)))
            out.append([*np.concatenate([(y[:, k].T @ y[:, k])[upper] for k in range(len(c))]), float(len(y))])
        return pd.Series(out)

    @F.pandas_udf("int")
    def counted(first: pd.Series, lent: pd.Series, length: pd.Series) -> pd.Series:
        return pd.Series([model.steps_in(int(f), int(b), int(n)) for f, b, n in zip(first, lent, length)], dtype="int32")

    tried = match(table, state.select(*keys, "tried"), keys)
    part = F.struct("chunk", counted("first", "lent", F.size("x")).alias("count"), ends("first", "lent", "x", "tried").alias("end"))
    parts = tried.select(*keys, part.alias("part")).groupBy(*keys).agg(F.sort_array(F.collect_list("part")).alias("parts"))  # no rows, only states
    begin = match(state.select(*keys, "tried"), parts, keys).select(*keys, F.explode(starts("tried", "parts")).alias("s")).select(*keys, "s.chunk", "s.state")
    begin = written(begin, "arima")
    joined = match(tried, begin.filter("chunk >= 0"), [*keys, "chunk"])
    return sum_arrays(joined.select(*keys, sums("first", "lent", "x", "tried", "state").alias("sums")), keys, "sums"), begin


def _improved(model: _Model):
    entries = model.state * (model.state + 1) // 2

    @F.pandas_udf("params array<double>, sse double, nobs long, gram array<double>, tried array<double>, moved boolean")
    def run(sums: pd.Series, tried: pd.Series, params: pd.Series, sse: pd.Series, gram: pd.Series) -> pd.DataFrame:
        rows = []
        for flat, cands, old, least, normal in zip(sums, tried, params, sse, gram):
            flat, cands = np.asarray(flat, float), np.asarray(cands, float).reshape(-1, model.size)
            old = np.asarray(old, float)
            least = math.inf if least is None or math.isnan(least) else least
            best = (least, old, normal)
            for k, c in enumerate(cands):
                own = flat[k * entries:(k + 1) * entries]
                if np.isfinite(own).all() and own[0] < best[0] and model.valid(c):
                    best = (float(own[0]), c, own)
            moved = not best[0] >= least * (1 - TOLERANCE)
            if best[2] is None or not len(best[2]):  # nothing finite: the start stays as it is
                rows.append((old.tolist(), None, 0, [], np.tile(old, len(STEPS)).tolist(), False))
                continue
            full = _square(best[2])
            step = -_solve(full, range(1, model.state))[0] if model.size else np.zeros(0)
            following = [best[1] + s * step for s in STEPS]
            following = [c if model.valid(c) else best[1] for c in following]
            rows.append((best[1].tolist(), best[0], int(flat[-1]), np.asarray(best[2]).tolist(), np.concatenate(following).tolist(), moved))
        return pd.DataFrame(rows, columns=["params", "sse", "nobs", "gram", "tried", "moved"])
    return run


def arima_fit(df: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value", order: tuple[int, int, int] = (2, 1, 2),
              long_lags: int = 12, rounds: int = ROUNDS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``keys, n, last_ts, params, sse, nobs, residuals, tail``: the fit of each series that is long enough.

    ``params`` are phi, theta and, without differences, the constant; ``residuals`` are the last ones, the newest first;
    ``tail`` the series' last values. Rounds end when no series gains. Runs a few jobs for each round.
    """
    keys = list(keys)
    model = _Model(order, long_lags)
    values = df.filter(F.col(value).isNotNull()).select(*keys, F.col(ts).alias("__ts"), F.col(value).cast("double").alias("x"))
    rows = numbered(values, keys, "__ts")
    table = written(chunks(rows, keys, "x", model.lent, chunk_rows), "chunks")

    def per_chunk(function):
        def run(*columns):
            return pd.Series([function(int(n), int(f), int(b), np.asarray(x, float), *rest) for n, f, b, x, *rest in zip(*columns)])
        return run

    @F.pandas_udf("array<double>")
    def long_sums(n: pd.Series, f: pd.Series, b: pd.Series, x: pd.Series) -> pd.Series:
        return per_chunk(model.long_sums)(n, f, b, x)

    @F.pandas_udf("array<double>")
    def start_sums(n: pd.Series, f: pd.Series, b: pd.Series, x: pd.Series, coefs: pd.Series) -> pd.Series:
        return per_chunk(model.start_sums)(n, f, b, x, coefs)

    @F.pandas_udf("array<double>")
    def coefficients(gram: pd.Series) -> pd.Series:
        return pd.Series([_solve(_square(g), range(1, 2 + model.long))[0] for g in gram])

    @F.pandas_udf("array<double>")
    def first_params(gram: pd.Series) -> pd.Series:
        return pd.Series([model.start(np.asarray(g, float)) for g in gram])

    @F.pandas_udf("boolean")
    def long_enough(n: pd.Series) -> pd.Series:
        return pd.Series([model.lag(int(k)) > 0 for k in n], dtype=bool)

    table = table.filter(long_enough("n"))
    gram = sum_arrays(table.select(*keys, long_sums("n", "first", "lent", "x").alias("g")), keys, "g")
    with_coefs = match(table, written(gram.select(*keys, coefficients("g").alias("c")), "arima"), keys)
    gram = sum_arrays(with_coefs.select(*keys, start_sums("n", "first", "lent", "x", "c").alias("g")), keys, "g")
    begin = gram.select(*keys, first_params("g").alias("params"))
    state = written(begin.select(*keys, "params", F.flatten(F.array_repeat("params", len(STEPS))).alias("tried"),
                                 F.lit(None).cast("double").alias("sse"), F.lit(None).cast("array<double>").alias("gram"),
                                 F.lit(0).cast("long").alias("nobs")), "arima")
    for _ in range(rounds):
        sums, _ = _residual_pass(model, table, state, keys)
        after = match(state, sums, keys).select(*keys, _improved(model)("sums", "tried", "params", "sse", "gram").alias("r"))
        state = written(after.select(*keys, "r.*"), "arima")
        if not state.filter("moved").limit(1).count():
            break
    _, begin = _residual_pass(model, table, state.withColumn("tried", F.col("params")), keys)
    ends = begin.filter("chunk = -1").select(*keys, F.col("state").alias("end"))
    tails = (table.groupBy(*keys, "n").agg(F.max_by(F.slice("x", F.lit(-1) * F.least(F.size("x"), F.lit(model.lent)), F.lit(model.lent)), "chunk").alias("tail")))
    last = rows.filter("__i = __n").select(*keys, F.col("__ts").alias("last_ts"))
    residuals = F.transform(F.sequence(F.lit(0), F.lit(model.depth - 1)), lambda k: F.get("end", k * model.state))
    fitted = match(match(match(state.select(*keys, "params", "sse", "nobs"), ends, keys), tails, keys), last, keys)
    return fitted.select(*keys, "n", "last_ts", "params", "sse", "nobs", residuals.alias("residuals"), "tail")


def _forecast(model: _Model, steps: int):
    p, d, q = model.p, model.d, model.q

    @F.pandas_udf("array<struct<step:int,forecast:double,lower_95:double,upper_95:double,aic:double>>")
    def run(params: pd.Series, sse: pd.Series, nobs: pd.Series, residuals: pd.Series, tail: pd.Series) -> pd.Series:
        out = []
        for par, ssr, n, last, levels in zip(params, sse, nobs, residuals, tail):
            phi, theta, const = np.split(np.asarray(par, float), [p, p + q])
            constant = float(const[0]) if len(const) else 0.0
            levels = np.asarray(levels, float)
            w = list(np.diff(levels, d))
            e = list(np.asarray(last, float)[::-1])
            ahead = []
            for _ in range(steps):
                value = constant + sum(phi[k] * w[-1 - k] for k in range(p)) + sum(theta[k] * e[-1 - k] for k in range(q))
                ahead.append(value)
                w.append(value)
                e.append(0.0)
            path = np.array(ahead)
            for k in range(d - 1, -1, -1):  # undo the differences, the last one first
                path = np.diff(levels, k)[-1] + np.cumsum(path)
            whole = np.r_[1.0, -phi]
            for _ in range(d):
                whole = np.convolve(whole, [1.0, -1.0])
            psi = np.zeros(steps)
            psi[0] = 1.0
            for k in range(1, steps):
                psi[k] = (theta[k - 1] if k <= q else 0.0) - sum(whole[j] * psi[k - j] for j in range(1, min(k, len(whole) - 1) + 1))
            sigma2 = ssr / n if n else math.nan
            wide = Z_975 * np.sqrt(sigma2 * np.cumsum(psi ** 2))
            aic = float(n * (math.log(2 * math.pi * sigma2) + 1) + 2 * (model.size + 1)) if sigma2 > 0 else None
            out.append([(k + 1, float(f), float(f - s), float(f + s), aic) for k, (f, s) in enumerate(zip(path, wide))])
        return pd.Series(out)
    return run


def arima(df: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value",
          order: tuple[int, int, int] = (2, 1, 2), steps: int = 90, long_lags: int = 12, rounds: int = ROUNDS,
          chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """ARIMA(p, d, q) forecasts ``(keys, ts, step, forecast, lower_95, upper_95, aic)``.

    Forecast days follow the last day of each series; ``ts`` must be a DATE column. AIC and bands are of the
    conditional sum of squares. A series that is too short to fit has one row with NULLs.
    """
    keys = list(keys)
    fit = written(arima_fit(df, keys, ts, value, order, long_lags, rounds, chunk_rows), "arima_fit")
    paths = fit.select(*keys, "last_ts", F.explode(_forecast(_Model(order, long_lags), steps)("params", "sse", "nobs", "residuals", "tail")).alias("f"))
    out = paths.select(*keys, F.date_add("last_ts", F.col("f.step")).alias(ts), "f.step", "f.forecast", "f.lower_95", "f.upper_95", "f.aic")
    if not keys:
        return out
    every = df.select(*keys).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    short = every.alias("a").join(fit.select(*keys).alias("b"), same, "left_anti")
    return out.unionByName(short.select(*keys), allowMissingColumns=True)


def naive(df: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value", steps: int = 30) -> DataFrame:
    """The last value of each series carried forward: ``(keys, ts, step, forecast)``; ``ts`` is a DATE."""
    keys = list(keys)
    last = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.max(F.struct(F.col(ts).alias("t"), F.col(value).alias("v"))).alias("l"))
    return last.select(*keys, F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"), "l").select(
        *keys, F.date_add("l.t", F.col("step")).alias(ts), "step", F.col("l.v").cast("double").alias("forecast"))
