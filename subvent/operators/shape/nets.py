"""Nets per segment: one fit of all segments together, however many there are and however their rows are spread.

Rows lie in blocks of a segment, a few thousand inputs each, and a table holds each segment's state: weights, the weights on trial, the
sums of the last accepted weights, and the damping. A pass sends every open segment's trial to its blocks, sums the
normal equations of the linearised nets per task and segment, and takes the next damped step of all segments in stacked solves. A
segment's steps are those of a fit of its rows alone; what has settled is left out of later passes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subvent.functions.activation import recu, recu_growth
from subvent.functions.checks import as_double, complete, refuse, require, weighted
from subvent.operators.shape.net import FIRST_DAMPING, RecuNet, advance_damping, first_weights, forward
from subvent.plans.lookup import BROADCAST_ROWS, attach
from subvent.sources.staging import kept_path, scratch, stage

# Inputs of a block, and segments whose sums a task holds at a time.
BLOCK, HELD = 4096, 1024
# Numbers of a broadcast state table, some tens of MB.
BROADCAST_NUMBERS = 5_000_000
ROW = "struct<kind:int,s:double,t:double,weight:double,m:double,q:double>"
STATE = (
    "seg bigint, theta array<double>, trial array<double>, sums array<double>, scales array<double>, blocks bigint, damping double, "
    "passes int, status string"
)
OPEN = "open"


@dataclass(frozen=True)
class RecuNets:
    """Nets of one size: a table with ``by``, ``theta`` and ``scales`` as in :class:`RecuNet`, ``n``, ``n_dropped``, ``loss``,
    ``passes`` and ``status`` (converged, not_converged, or no_rows, without weights)."""

    table: DataFrame
    by: tuple[str, ...]
    power: float
    x_shape: str
    x_free: str | None
    hidden: int

    def weights(self) -> DataFrame:
        """A row per segment and hidden unit; unit 0 carries c in ``b``."""
        h = self.hidden
        part = lambda i: F.get("theta", F.col("unit") + (i * h))
        unit = F.explode(F.sequence(F.lit(0), F.lit(h))).alias("unit")
        some = F.col("unit") > 0
        return self.table.filter("theta IS NOT NULL").select(*self.by, "theta", unit).select(
            *self.by, "unit", F.when(some, part(1)).alias("a"), F.when(some, part(2)).alias("u"), F.when(some, part(0)).alias("v"),
            F.when(some, part(3)).otherwise(F.get("theta", F.lit(0))).alias("b"),
        )

    def attach_to(self, df: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
        """``df`` with the ``theta`` and ``scales`` of each row's segment."""
        return attach(df, self.table.select(*self.by, "theta", "scales", "n"), list(self.by), "n", broadcast_rows)

    def value(self, s: Column, t: Column | None = None) -> Column:
        """The net of the row's own ``theta`` and ``scales`` as a column in raw units, summed up as that of :class:`RecuNet`."""
        get = lambda i: F.get("theta", F.lit(i))
        scale = lambda i: F.get("scales", F.lit(i))
        soft = lambda x: F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))
        s = (s.cast("double") - scale(0)) / scale(1)
        t = F.lit(0.0) if t is None else (t.cast("double") - scale(2)) / scale(3)
        lowest, added, h = get(0), F.lit(0.0), self.hidden
        for k in range(1, h + 1):
            inner, size = get(2 * h + k) * t + get(3 * h + k), soft(get(k))
            lowest = lowest + size * recu(inner, self.power)
            added = added + size * recu_growth(inner, soft(get(h + k)) * s, self.power)
        return (lowest * scale(5) + scale(4)) + added * scale(5)

    def save(self, path: str) -> None:
        self.table.write.parquet(f"{path}/nets")
        row = (list(self.by), self.power, self.x_shape, self.x_free, self.hidden)
        schema = "by array<string>, power double, x_shape string, x_free string, hidden int"
        self.table.sparkSession.createDataFrame([row], schema).write.parquet(f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> RecuNets:
        a = spark.read.parquet(f"{path}/about").first()
        return RecuNets(spark.read.parquet(f"{path}/nets"), tuple(a["by"]), a["power"], a["x_shape"], a["x_free"], a["hidden"])


def entries_of(p: int) -> int:
    """Numbers in the sums of a net of ``p`` weights: J'J above its diagonal and on it, J'r, the loss."""
    return p * (p + 1) // 2 + p + 1


def block_sums(theta: np.ndarray, power: float, scales: np.ndarray, rows: dict[str, np.ndarray], priors: Sequence) -> np.ndarray:
    """The sums of one block's rows, data (kind -1) and points of priors, for the weights of its segment."""
    p = len(theta)
    jj, jr, loss = np.zeros((p, p)), np.zeros(p), 0.0
    kind = rows["kind"]
    _, s_width, _, _, y_mean, y_sd = scales
    for i in np.unique(kind):
        on = kind == i
        s, t, weight = rows["s"][on], rows["t"][on], rows["weight"][on]
        if i < 0:
            value, jac = forward(theta, power, s, t)
            miss = value - rows["m"][on]
            loss += float(weight @ (miss**2 + rows["q"][on]))
        else:
            prior = priors[i]
            value, jac = np.zeros(len(s)), np.zeros((len(s), p))
            for offset, coef in prior.stencil:
                f, one = forward(theta, power, s + offset / s_width, t)
                value += coef * f
                jac += coef * one
            miss = value - (prior.target - y_mean * sum(c for _, c in prior.stencil)) / y_sd
            if prior.relation != "=":
                breach = miss < 0 if prior.relation == ">=" else miss > 0
                miss, jac = np.where(breach, miss, 0.0), jac * breach[:, None]
            loss += float(weight @ miss**2)
        jj += jac.T @ (jac * weight[:, None])
        jr += jac.T @ (weight * miss)
    return np.concatenate([jj[np.triu_indices(p)], jr, [loss]])


def _arrays(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _pass(blocks: DataFrame, state: DataFrame, p: int, power: float, priors: Sequence, small: bool) -> DataFrame:
    """One pass of all open segments: sums (seg, sums) per task and segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            values = pa.array(np.concatenate(list(held.values())))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(held) + 1, dtype=np.int32) * entries_of(p)), values)
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), lists], ["seg", "sums"])
            held.clear()
            return batch

        for batch in batches:
            if not batch.num_rows:
                continue
            seg, theta = batch.column("seg").to_pylist(), _arrays(batch.column("trial"), p)
            scales = _arrays(batch.column("scales"), 6)
            lists = batch.column("rows")
            ends = np.asarray(lists.offsets) - lists.offsets[0].as_py()
            flat = lists.flatten()
            fields = {f.name: flat.field(f.name).to_numpy(zero_copy_only=False) for f in flat.type}
            for k, one in enumerate(seg):
                rows = {c: v[ends[k] : ends[k + 1]] for c, v in fields.items()}
                sums = block_sums(theta[k], power, scales[k], rows, priors)
                held[one] = held[one] + sums if one in held else sums
                if len(held) == HELD:
                    yield out()
        if held:
            yield out()

    trial = state.filter(F.col("status") == OPEN).select("seg", "trial", "scales", "blocks")
    met = blocks.join(F.broadcast(trial), "seg") if small else attach(blocks, trial, ["seg"], "blocks", 0).filter("trial IS NOT NULL")
    return met.select("seg", "trial", "scales", "rows").mapInArrow(run, "seg bigint, sums array<double>")


def next_state(state: dict[str, np.ndarray], sums: np.ndarray, last: bool) -> dict[str, np.ndarray]:
    """What :func:`subvent.operators.shape.net.descend` does after a pass, for many segments at once.

    ``state`` holds theta, trial, sums (NaN before the first pass), damping, passes and status by segment.
    """
    out = {c: v.copy() for c, v in state.items()}
    p = out["theta"].shape[1]
    first = np.isnan(out["sums"][:, -1])
    before, now = out["sums"][:, -1], sums[:, -1]
    falls = first | (now < before)
    with np.errstate(invalid="ignore"):
        done = advance_damping(out["damping"], before, now, first)
    out["damping"] = done[0]
    out["status"][done[1]] = "converged"
    out["theta"][falls], out["sums"][falls] = out["trial"][falls], sums[falls]
    out["passes"] = out["passes"] + 1
    open_ = out["status"] == OPEN
    if last:
        out["status"][open_] = "not_converged"
        return out
    at = np.flatnonzero(open_)
    if len(at):
        upper = np.triu_indices(p)
        jj = np.zeros((len(at), p, p))
        jj[:, upper[0], upper[1]] = out["sums"][at, : len(upper[0])]
        jj = jj + np.triu(jj, 1).transpose(0, 2, 1)
        jr = out["sums"][at, len(upper[0]) : -1]
        diagonal = np.einsum("kii->ki", jj)
        scale = diagonal + 1e-8 * np.maximum(diagonal.max(axis=1), 1e-12)[:, None]
        damped = jj + (out["damping"][at, None] * scale)[:, :, None] * np.eye(p)
        out["trial"][at] = out["theta"][at] + np.linalg.solve(damped, -jr[:, :, None])[:, :, 0]
    return out


def descend_segments(blocks: DataFrame, state: DataFrame, p: int, power: float, iters: int, priors: Sequence = ()) -> DataFrame:
    """The state after at most ``iters`` steps of every segment; each pass is one job over the blocks of open segments."""
    names = [f.split()[0] for f in STATE.split(", ")]
    width = entries_of(p)
    segments = state.count()
    small = segments * (p + 6) <= BROADCAST_NUMBERS
    tasks = max(1, math.ceil(segments * (width + 3 * p) / BROADCAST_NUMBERS), min(segments, blocks.sparkSession.sparkContext.defaultParallelism))

    def advance(last: bool):
        def run(held: pa.Table, heard: pa.Table) -> pa.Table:
            column = lambda t, c: t.column(c).combine_chunks()
            order = column(held, "seg").to_numpy().argsort(kind="stable")
            held = held.take(pa.array(order))
            seg = column(held, "seg").to_numpy()
            is_open = np.asarray(column(held, "status").to_pylist(), dtype=object) == OPEN
            old = {
                "theta": _arrays(column(held, "theta"), p), "trial": _arrays(column(held, "trial"), p),
                "sums": _arrays(column(held, "sums"), width), "damping": column(held, "damping").to_numpy(zero_copy_only=False),
                "passes": column(held, "passes").to_numpy(), "status": np.asarray(column(held, "status").to_pylist(), dtype=object),
            }
            sums = np.zeros((len(seg), width))
            if heard.num_rows:
                np.add.at(sums, np.searchsorted(seg, column(heard, "seg").to_numpy()), _arrays(column(heard, "sums"), width))
            new = {c: v.copy() for c, v in old.items()}
            moved = next_state({c: v[is_open] for c, v in old.items()}, sums[is_open], last)
            for c, v in moved.items():
                new[c][is_open] = v
            lists = lambda v: pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * v.shape[1]), pa.array(v.ravel()))
            done = {
                "seg": pa.array(seg), "theta": lists(new["theta"]), "trial": lists(new["trial"]), "sums": lists(new["sums"]),
                "scales": column(held, "scales"), "blocks": column(held, "blocks"), "damping": pa.array(new["damping"].astype(float)),
                "passes": pa.array(new["passes"].astype(np.int32)), "status": pa.array(new["status"].tolist(), pa.string()),
            }
            return pa.table([done[c] for c in names], names)

        return run

    for number in range(iters + 1):
        last = number == iters
        task = F.pmod(F.xxhash64("seg"), F.lit(tasks)).alias("_task")
        sums = _pass(blocks, state, p, power, priors, small)
        grouped = state.select("*", task).groupBy("_task").cogroup(sums.select("*", task).groupBy("_task"))
        state = stage(grouped.applyInArrow(advance(last), STATE), "net_state")
        if not last and state.filter(F.col("status") == OPEN).isEmpty():
            break
    return state


def fit_segments(
    df: DataFrame, x_shape: str, x_free: str | None, y: str, by: Sequence[str], hidden: int, power: float, iters: int,
    init: RecuNet | RecuNets | None, seed: int, weight: str | None, points: DataFrame | None = None, priors: Sequence = (), lam: float = 0.0,
) -> RecuNets:
    """A net per segment of ``by``; ``points`` and ``priors`` add the penalty of a prior fit, each prior weighing ``lam * weight`` a segment."""
    by = list(by)
    inputs = [x_shape] + ([x_free] if x_free else [])
    require(df, by, [*inputs, y] + ([weight] if weight else []))
    spark = df.sparkSession
    if init is not None:
        hidden, power = init.hidden, init.power
    p = 1 + 4 * hidden
    ok = complete([*inputs, y]) & weighted(weight)
    s, yy = as_double(df, x_shape), as_double(df, y)
    t = as_double(df, x_free) if x_free else F.lit(0.0)
    size = as_double(df, weight) if weight else F.lit(1.0)
    with scratch(spark):
        own = lambda c: F.when(ok, c)
        about = df.groupBy(*by).agg(
            F.count(own(F.lit(1))).alias("n"), F.count(F.lit(1)).alias("total"), F.sum(own(size)).alias("size"),
            F.min(own(s)).alias("s_low"), F.max(own(s)).alias("s_high"), F.min(own(t)).alias("t_low"), F.max(own(t)).alias("t_high"),
            (F.sum(own(size * yy)) / F.sum(own(size))).alias("y_mean"),
        )
        about = stage(about.withColumn("seg", F.monotonically_increasing_id()), "net_segments")
        rows = attach(df.filter(ok).select(*by, s.alias("s"), t.alias("t"), yy.alias("y"), size.alias("size")), about.select(*by, "seg", "y_mean", "n"), by, "n")
        rows = stage(rows.select("seg", "s", "t", (F.col("y") - F.col("y_mean")).alias("y"), "size"), "net_inputs")
        # about the mean, so that no digits cancel
        spread = rows.groupBy("seg").agg(F.sqrt(F.sum(F.col("size") * F.col("y") * F.col("y")) / F.sum("size")).alias("y_sd"))
        or_one = lambda c: F.when(c != 0, c).otherwise(1.0)
        scales = F.array(
            "s_low", or_one(F.col("s_high") - F.col("s_low")), "t_low", or_one(F.col("t_high") - F.col("t_low")), "y_mean", or_one(F.col("y_sd"))
        )
        start = np.asarray(init.theta) if isinstance(init, RecuNet) else first_weights(hidden, seed, x_free is not None)
        theta = F.array(*[F.lit(float(v)) for v in start])
        if isinstance(init, RecuNet):
            scales = F.array(*[F.lit(float(v)) for v in init.scales])
        segments = about.join(spread, "seg", "left")
        if isinstance(init, RecuNets):
            given = stage(init.table.select(*by, F.col("theta").alias("_theta"), F.col("scales").alias("_scales"), F.lit(1).alias("_one")), "net_start")
            segments = attach(segments, given, by, "_one")
            theta, scales = F.coalesce("_theta", theta), F.coalesce("_scales", scales)
        segments = stage(
            segments.select(*by, "seg", "n", (F.col("total") - F.col("n")).alias("n_dropped"), "size", "y_mean", theta.alias("theta"), F.when(F.col("n") > 0, scales).alias("scales")),
            "net_segments",
        )
        known = segments.filter("n > 0")
        met = attach(rows, known.select("seg", "scales", "size", "y_mean", "n").withColumnRenamed("size", "all_size"), ["seg"], "n")
        at = lambda c, k: (F.col(c) - F.get("scales", F.lit(k))) / F.get("scales", F.lit(k + 1))
        centred = (F.col("y") + F.col("y_mean") - F.get("scales", F.lit(4))) / F.get("scales", F.lit(5))
        share = F.col("size") / F.col("all_size")
        cells = (
            met.select("seg", at("s", 0).alias("s"), at("t", 2).alias("t"), centred.alias("y"), share.alias("weight"))
            .groupBy("seg", "s", "t")
            .agg(F.sum("weight").alias("weight"), F.sum(F.col("weight") * F.col("y")).alias("wy"), F.sum(F.col("weight") * F.col("y") * F.col("y")).alias("wyy"))
            .select("seg", F.lit(-1).alias("kind"), "s", "t", "weight", (F.col("wy") / F.col("weight")).alias("m"), F.greatest(F.col("wyy") / F.col("weight") - (F.col("wy") / F.col("weight")) ** 2, F.lit(0.0)).alias("q"))
        )
        if points is not None:
            cells = cells.unionByName(_point_rows(points, known, x_shape, x_free, by, priors, lam))
        cells = stage(cells, "net_cells")
        counts = stage(cells.groupBy("seg").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.count("*").alias("_cells")), "net_counts")
        row = F.struct("kind", "s", "t", "weight", "m", "q").cast(ROW)
        block = F.pmod(F.xxhash64("kind", "s", "t"), F.col("blocks"))
        blocks = attach(cells, counts, ["seg"], "_cells").groupBy("seg", block.alias("block")).agg(F.collect_list(row).alias("rows"))
        blocks = stage(blocks.select("seg", "rows"), "net_blocks", spread=True)
        state = known.join(counts, "seg").select(
            "seg", "theta", F.col("theta").alias("trial"), F.array_repeat(F.lit(float("nan")), entries_of(p)).alias("sums"), "scales", "blocks",
            F.lit(FIRST_DAMPING).alias("damping"), F.lit(0).alias("passes"), F.lit(OPEN).alias("status"),
        )
        state = descend_segments(blocks, stage(state, "net_state"), p, power, iters, priors)
        ended = state.select("seg", F.col("theta").alias("_theta"), F.element_at("sums", -1).alias("_loss"), "passes", "status")
        table = segments.join(ended, "seg", "left").select(
            *by, F.col("_theta").alias("theta"), "scales", "n", "n_dropped", (F.col("_loss") * F.get("scales", F.lit(5)) ** 2).alias("loss"),
            F.coalesce("passes", F.lit(0)).alias("passes"), F.coalesce("status", F.lit("no_rows")).alias("status"),
        )
        path = kept_path(spark, "nets")
        table.write.parquet(path)
        table = spark.read.schema(table.schema).parquet(path)
    return RecuNets(table, tuple(by), float(power), x_shape, x_free, hidden)


def _point_rows(points: DataFrame, known: DataFrame, x_shape: str, x_free: str | None, by: list[str], priors: Sequence, lam: float) -> DataFrame:
    """The points of each prior as rows of their segments' normal equations; a segment without data has no fit."""
    require(points, by, [x_shape, *([x_free] if x_free else []), "lo", "hi"])
    s = F.col(x_shape).cast("double")
    t = F.col(x_free).cast("double") if x_free else F.lit(0.0)
    kinds = F.array(*[F.when(p.inside(s, F.col("lo"), F.col("hi")), F.lit(i)) for i, p in enumerate(priors)])
    # the segments' row counts stand in for those of their points: they only balance
    at = attach(points.select(*by, s.alias("s"), t.alias("t"), kinds.alias("kinds")), known.select(*by, "seg", "scales", "n"), by, "n")
    at = stage(at.filter("seg IS NOT NULL").withColumn("kind", F.explode("kinds")).filter("kind IS NOT NULL"), "net_points")
    counts = stage(at.groupBy("seg", "kind").agg(F.count("*").alias("_points")), "net_point_counts")
    weights = F.array(*[F.lit(float(lam) * p.weight) for p in priors])
    at = attach(at, counts.withColumn("_rows", F.col("_points")), ["seg", "kind"], "_rows")
    scaled = lambda c, k: (F.col(c) - F.get("scales", F.lit(k))) / F.get("scales", F.lit(k + 1))
    return at.select(
        "seg", "kind", scaled("s", 0).alias("s"), scaled("t", 2).alias("t"), (F.get(weights, F.col("kind")) / F.col("_points")).alias("weight"),
        F.lit(0.0).alias("m"), F.lit(0.0).alias("q"),
    )


def predict_segments(df: DataFrame, nets: RecuNets, pred: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with the value of its segment's net; NULL where an input is NULL or the segment has no net."""
    inputs = [nets.x_shape] + ([nets.x_free] if nets.x_free else [])
    require(df, nets.by, inputs)
    refuse(df, [pred, "theta", "scales"])
    value = nets.value(F.col(nets.x_shape), F.col(nets.x_free) if nets.x_free else None)
    return nets.attach_to(df, broadcast_rows).select(*df.columns, value.alias(pred))
