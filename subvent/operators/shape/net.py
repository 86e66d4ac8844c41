"""One-hidden-layer net that is convex and rising in one input by construction.

f = c + sum_k softplus(v_k) * recu(softplus(a_k) * s + u_k * t + b_k), with s the shaped and t the
free input, both scaled to about [0, 1]. Each pass over the rows sums the normal equations of
the linearised net, whose size depends on the net alone; the damped step is taken on the
driver. That needs some tens of passes where plain gradients need hundreds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from typing import TYPE_CHECKING

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subvent.functions.activation import check_power, recu, recu_growth
from subvent.functions.checks import as_double, complete, refuse, require, weighted
from subvent.sources.staging import stage

if TYPE_CHECKING:
    from subvent.operators.shape.nets import RecuNets

WEIGHTS_SCHEMA = "unit int, a double, u double, v double, b double"
# Equal inputs are merged when that leaves at least this many rows per distinct input.
ROWS_PER_INPUT = 4
FIRST_DAMPING = 1e-2


def softplus(x):
    return np.logaddexp(0.0, x)


def _sigmoid(x):
    return np.exp(-np.logaddexp(0.0, -x))


@dataclass(frozen=True)
class RecuNet:
    """Weights of a net with the scales of its inputs and output.

    ``theta`` holds c, then v, a, u and b of the hidden units; v and a are before softplus.
    """

    theta: tuple[float, ...]
    power: float
    x_shape: str
    x_free: str | None
    scales: tuple[float, float, float, float, float, float]  # s: low, width; t: low, width; y: mean, sd
    n: int = 0
    n_dropped: int = 0
    loss: float | None = None
    passes: int = 0
    status: str = "given"  # or, of a fit: converged, not_converged

    @property
    def hidden(self) -> int:
        return (len(self.theta) - 1) // 4

    def parts(self) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        theta, h = np.asarray(self.theta), self.hidden
        return theta[0], *(theta[1 + i * h : 1 + (i + 1) * h] for i in range(4))

    def value(self, s: Column, t: Column | None = None) -> Column:
        """The net as a column in raw units: plain arithmetic, no worker.

        It is the value where s is lowest, and what each unit adds from there: these have one sign, so digits that the
        units lose against c are lost there alone, and the rounding along s is that of the result.
        """
        s_low, s_width, t_low, t_width, y_mean, y_sd = self.scales
        c, v, a, u, b = self.parts()
        s = (s.cast("double") - s_low) / s_width
        t = F.lit(0.0) if t is None else (t.cast("double") - t_low) / t_width
        lowest, added = F.lit(float(c)), F.lit(0.0)
        for k in range(self.hidden):
            inner, size = F.lit(float(u[k])) * t + F.lit(float(b[k])), F.lit(float(softplus(v[k])))
            lowest = lowest + size * recu(inner, self.power)
            added = added + size * recu_growth(inner, F.lit(float(softplus(a[k]))) * s, self.power)
        return (lowest * F.lit(float(y_sd)) + F.lit(float(y_mean))) + added * F.lit(float(y_sd))

    def to_df(self, spark: SparkSession) -> DataFrame:
        """The hidden units as a table; unit 0 carries c in ``b``."""
        c, v, a, u, b = self.parts()
        rows = [(0, None, None, None, float(c))]
        rows += [(k + 1, float(a[k]), float(u[k]), float(v[k]), float(b[k])) for k in range(self.hidden)]
        return spark.createDataFrame(rows, WEIGHTS_SCHEMA)

    @staticmethod
    def from_df(
        weights: DataFrame, power: float, x_shape: str, x_free: str | None, scales: Sequence[float]
    ) -> RecuNet:
        """A net from an existing weights table, for scoring or as a warm start."""
        rows = sorted(weights.collect(), key=lambda r: r["unit"])
        units = rows[1:]
        theta = [rows[0]["b"], *[r[c] for c in ("v", "a", "u", "b") for r in units]]
        return RecuNet(tuple(theta), power, x_shape, x_free, tuple(scales))


    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.to_df(spark).write.parquet(f"{path}/weights")
        row = (
            self.power, self.x_shape, self.x_free, list(self.scales), self.n, self.n_dropped, self.loss, self.passes, self.status,
        )
        schema = (
            "power double, x_shape string, x_free string, scales array<double>, n bigint, n_dropped bigint, loss double, "
            "passes int, status string"
        )
        spark.createDataFrame([row], schema).write.parquet(f"{path}/scales")

    @staticmethod
    def load(spark: SparkSession, path: str) -> RecuNet:
        s = spark.read.parquet(f"{path}/scales").first().asDict()
        net = RecuNet.from_df(spark.read.parquet(f"{path}/weights"), s["power"], s["x_shape"], s["x_free"], s["scales"])
        return replace(net, **{c: s[c] for c in ("n", "n_dropped", "loss", "passes", "status") if c in s})


def forward(theta: np.ndarray, power: float, s: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Value and Jacobian in the weights, for scaled inputs."""
    h = (len(theta) - 1) // 4
    v, a, u, b = (theta[1 + i * h : 1 + (i + 1) * h] for i in range(4))
    inner = np.maximum(s[:, None] * softplus(a) + t[:, None] * u + b, 0.0)
    active = inner**power
    grow = softplus(v) * power * inner ** (power - 1)
    value = theta[0] + active @ softplus(v)
    jacobian = np.concatenate(
        [
            np.ones((len(s), 1)),
            active * _sigmoid(v),
            grow * s[:, None] * _sigmoid(a),
            grow * t[:, None],
            grow,
        ],
        axis=1,
    )
    return value, jacobian


@dataclass(frozen=True)
class Stencils:
    """Priors over scaled inputs: per prior the offsets, coefficients, relation, target and weight per point."""

    offsets: tuple[tuple[float, ...], ...] = ()
    coefs: tuple[tuple[float, ...], ...] = ()
    relations: tuple[str, ...] = ()
    targets: tuple[float, ...] = ()


def sum_equations(rows: DataFrame, theta: np.ndarray, power: float, stencils: Stencils) -> tuple[np.ndarray, np.ndarray, float]:
    """One pass: J'J, J'r and the loss, where r is the residual of data and of priors in breach.

    ``rows`` holds kind, s, t, weight, m and q: for data (kind -1) weighted cells with mean outcome m and
    within-cell square q; for points kind is the number of the prior.
    """
    p = len(theta)
    upper = np.triu_indices(p)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        jj, jr, loss = np.zeros((p, p)), np.zeros(p), 0.0
        for batch in batches:
            kind = batch["kind"].to_numpy()
            data = batch[kind < 0]
            if len(data):
                f, jac = forward(theta, power, data["s"].to_numpy(), data["t"].to_numpy())
                weight, miss = data["weight"].to_numpy(), f - data["m"].to_numpy()
                jj += jac.T @ (jac * weight[:, None])
                jr += jac.T @ (weight * miss)
                loss += float(weight @ (miss**2 + data["q"].to_numpy()))
            for i in np.unique(kind[kind >= 0]):
                points = batch[kind == i]
                s, t = points["s"].to_numpy(), points["t"].to_numpy()
                value, jac = np.zeros(len(s)), np.zeros((len(s), p))
                for offset, coef in zip(stencils.offsets[i], stencils.coefs[i]):
                    f, one = forward(theta, power, s + offset, t)
                    value += coef * f
                    jac += coef * one
                miss = value - stencils.targets[i]
                if stencils.relations[i] == ">=":
                    miss, jac = np.minimum(miss, 0.0), jac * (miss < 0)[:, None]
                elif stencils.relations[i] == "<=":
                    miss, jac = np.maximum(miss, 0.0), jac * (miss > 0)[:, None]
                weight = points["weight"].to_numpy()
                jj += jac.T @ (jac * weight[:, None])
                jr += jac.T @ (weight * miss)
                loss += float(weight @ miss**2)
        entries = np.concatenate([jj[upper], jr, [loss]])
        yield pd.DataFrame({"entry": np.arange(len(entries), dtype=np.int32), "value": entries})

    sums = rows.mapInPandas(partial, "entry int, value double").groupBy("entry").agg(F.sum("value").alias("value"))
    entries = sums.toPandas().sort_values("entry")["value"].to_numpy()
    jj = np.zeros((p, p))
    jj[upper] = entries[: len(upper[0])]
    jj = jj + np.triu(jj, 1).T
    return jj, entries[len(upper[0]) : -1], float(entries[-1])


def advance_damping(damping, before, now, first):
    """The damping after a trial whose loss is ``now``, and whether the fit has converged; ``first``: nothing to compare it with.

    Plain numbers or arrays of many fits.
    """
    falls = now < before
    settled = falls & (before - now <= 1e-10 * np.maximum(before, 1e-12))
    after = np.where(first, damping, np.where(falls, np.maximum(damping / 5, 1e-10), damping * 8))
    return after, np.logical_not(first) & (settled | (np.logical_not(falls) & (after > 1e10)))


def descend(rows: DataFrame, theta: np.ndarray, power: float, iters: int, stencils: Stencils = Stencils()):
    """Damped Gauss-Newton steps; a step that raises the loss is taken back and damped more.

    Returns the weights, their loss, the passes over the rows, and ``converged`` once a step gains next to nothing or
    no step gains anything; ``not_converged`` after ``iters`` steps.
    """
    jj, jr, loss = sum_equations(rows, theta, power, stencils)
    damping, passes, status = FIRST_DAMPING, 1, "not_converged"
    for _ in range(iters):
        scale = np.diag(jj) + 1e-8 * max(np.diag(jj).max(), 1e-12)
        step = np.linalg.solve(jj + damping * np.diag(scale), -jr)
        trial = sum_equations(rows, theta + step, power, stencils)
        passes += 1
        damping, done = advance_damping(damping, loss, trial[2], False)
        if trial[2] < loss:
            theta, (jj, jr, loss) = theta + step, trial
        if done:
            status = "converged"
            break
    return theta, loss, passes, status


def first_weights(hidden: int, seed: int, has_free: bool) -> np.ndarray:
    """Half of the bends far left of the data, where a unit is nearly straight, and half spread over it."""
    rng = np.random.default_rng(seed)
    bends = np.concatenate([-np.geomspace(8.0, 0.5, hidden // 2), np.linspace(0.0, 0.8, hidden - hidden // 2)])
    a = 0.5 + 0.1 * rng.standard_normal(hidden)
    u = 0.3 * rng.standard_normal(hidden) if has_free else np.zeros(hidden)
    return np.concatenate([[0.0], np.zeros(hidden), a, u, -softplus(a) * bends])


def scaled_rows(
    df: DataFrame, x_shape: str, x_free: str | None, y: str, init: RecuNet | None, weight: str | None = None
) -> tuple[DataFrame, tuple[float, ...], int, int]:
    """Staged rows for :func:`sum_equations`, the scales used, and the rows used and left out.

    Equal inputs are merged into one weighted cell when the data repeat them; weights sum to 1.
    """
    inputs = [x_shape] + ([x_free] if x_free else [])
    require(df, [], [*inputs, y] + ([weight] if weight else []))
    ok = complete([*inputs, y]) & weighted(weight)
    size = as_double(df, weight) if weight else F.lit(1.0)
    s, yy = as_double(df, x_shape), as_double(df, y)
    t = as_double(df, x_free) if x_free else F.lit(0.0)
    about = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(ok, 1)).alias("n"),
        *[f(F.when(ok, c)).alias(a) for c, a, f in (
            (s, "s_low", F.min), (s, "s_high", F.max), (t, "t_low", F.min), (t, "t_high", F.max),
            (yy, "y_mean", F.avg), (yy, "y_sd", F.stddev_pop), (size, "size", F.sum),
        )],
        (F.sum(F.when(ok, size * yy)) / F.sum(F.when(ok, size))).alias("y_weighted"),
        F.approx_count_distinct(F.when(ok, F.struct(s, t))).alias("inputs"),
    ).first()
    if not about["n"]:
        raise ValueError("no row has all of " + ", ".join([*inputs, y]))
    mean, sd = about["y_mean"], about["y_sd"]
    if weight and not init:
        mean = about["y_weighted"]
        sd = df.filter(ok).agg(F.sqrt(F.sum(size * (yy - mean) ** 2) / F.sum(size))).first()[0]
    scales = init.scales if init else (
        about["s_low"], (about["s_high"] - about["s_low"]) or 1.0,
        about["t_low"], (about["t_high"] - about["t_low"]) or 1.0,
        mean, sd or 1.0,
    )
    rows = df.filter(ok).select(
        ((s - scales[0]) / scales[1]).alias("s"),
        ((t - scales[2]) / scales[3]).alias("t"),
        ((yy - scales[4]) / scales[5]).alias("y"),
        (size / about["size"]).alias("weight"),
    )
    share = 1.0 / about["n"]
    if weight and about["n"] >= ROWS_PER_INPUT * about["inputs"]:
        w, y = F.col("weight"), F.col("y")
        rows = rows.groupBy("s", "t").agg(F.sum(w).alias("weight"), (F.sum(w * y) / F.sum(w)).alias("m"), (F.sum(w * y * y) / F.sum(w)).alias("q"))
        rows = rows.withColumn("q", F.greatest(F.col("q") - F.col("m") * F.col("m"), F.lit(0.0)))
    elif weight:
        rows = rows.select("s", "t", "weight", F.col("y").alias("m"), F.lit(0.0).alias("q"))
    elif about["n"] >= ROWS_PER_INPUT * about["inputs"]:
        rows = rows.groupBy("s", "t").agg(
            (F.count(F.lit(1)) * share).alias("weight"), F.avg("y").alias("m"), F.var_pop("y").alias("q")
        )
    else:
        rows = rows.select("s", "t", F.lit(share).alias("weight"), F.col("y").alias("m"), F.lit(0.0).alias("q"))
    rows = rows.select(F.lit(-1).alias("kind"), "s", "t", "weight", "m", "q")
    return stage(rows, "net_rows"), scales, about["n"], about["total"] - about["n"]


def recu_net_fit(
    df: DataFrame,
    x_shape: str,
    x_free: str | None,
    y: str,
    hidden: int = 8,
    power: float = 2,
    iters: int = 30,
    init: RecuNet | RecuNets | None = None,
    seed: int = 0,
    by: Sequence[str] = (),
    weight: str | None = None,
) -> RecuNet | RecuNets:
    """Fit the net by least squares; ``init`` continues from existing weights and keeps their scales.

    The net is also convex in ``x_free``; where that is wrong, fit one net per segment: with ``by`` all segments are fitted together and
    the result is a table of nets, each as a fit of its rows alone. ``init`` may then be one net for all or such a table. A row with a
    ``weight`` counts as that many rows; one without a positive weight is left out.
    """
    check_power(power)
    if by:
        from subvent.operators.shape.nets import fit_segments

        return fit_segments(df, x_shape, x_free, y, by, hidden, power, iters, init, seed, weight)
    rows, scales, n, dropped = scaled_rows(df, x_shape, x_free, y, init, weight)
    theta = np.asarray(init.theta) if init else first_weights(hidden, seed, x_free is not None)
    theta, loss, passes, status = descend(rows, theta, init.power if init else power, iters)
    return RecuNet(
        tuple(theta.tolist()), init.power if init else float(power), x_shape, x_free, tuple(scales), n, dropped,
        loss * scales[5] ** 2, passes, status,
    )


def recu_net_predict(df: DataFrame, net: RecuNet | RecuNets, pred: str = "pred") -> DataFrame:
    """``df`` with the net's value, or that of its segment's net; NULL where an input is NULL or the segment has none."""
    if not isinstance(net, RecuNet):
        from subvent.operators.shape.nets import predict_segments

        return predict_segments(df, net, pred)
    inputs = [net.x_shape] + ([net.x_free] if net.x_free else [])
    require(df, [], inputs)
    refuse(df, [pred])
    return df.withColumn(pred, net.value(F.col(net.x_shape), F.col(net.x_free) if net.x_free else None))
