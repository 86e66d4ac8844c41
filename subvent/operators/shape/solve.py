"""Small sign-constrained least squares on a Gram matrix (a handful of terms)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd

from subvent.operators.shape.gram import COUNTS

# fixed value: a descent below this share of the largest counts as none
TOLERANCE = 1e-12


def unpack(rows: pd.DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, float, float, float]:
    """X'X, X'y, y'y, rows used and rows left out from the long form of one segment."""
    full = np.zeros((k + 1, k + 1))
    body = rows[rows["i"] != COUNTS]
    i, j = body["i"].to_numpy(), body["j"].to_numpy()
    np.add.at(full, (i, j), body["value"].to_numpy())
    full = np.triu(full) + np.triu(full, 1).T
    counts = rows[rows["i"] == COUNTS].groupby("j")["value"].sum()
    return full[:k, :k], full[:k, k], full[k, k], float(counts.get(0, 0)), float(counts.get(1, 0))


def solve_signed(g: np.ndarray, b: np.ndarray, signs: list[int]) -> np.ndarray:
    """The minimiser of :func:`solve_signed_status`."""
    return solve_signed_status(g, b, signs)[0]


def solve_signed_status(g: np.ndarray, b: np.ndarray, signs: list[int]) -> tuple[np.ndarray, bool]:
    """Minimise c'Gc - 2b'c with ``sign * c >= 0`` where a sign is given; also whether the search ended.

    Terms enter one at a time, by steepest descent, and leave when they would change sign.
    Columns are scaled to unit length and b to a largest entry of 1 first, so the result scales with the outcome;
    a column of zeros keeps coefficient 0.
    """
    k = len(b)
    flip = np.array([s or 1 for s in signs], dtype=float)
    scale = np.sqrt(np.diag(g))
    alive = scale > 0
    scale = np.where(alive, scale, 1.0)
    change = flip / scale
    g, b = g * np.outer(change, change), b * change
    size = float(np.abs(b).max(initial=0.0))
    if size == 0:
        return np.zeros(k), True
    b = b / size
    bound = np.array([s != 0 for s in signs])
    inside = alive & ~bound
    c = np.zeros(k)

    def fit(chosen: np.ndarray) -> np.ndarray:
        out = np.zeros(k)
        at = np.flatnonzero(chosen)
        if len(at):
            part = g[np.ix_(at, at)]
            try:
                out[at] = np.linalg.solve(part, b[at])
            except np.linalg.LinAlgError:
                out[at] = np.linalg.lstsq(part, b[at], rcond=None)[0]
        return out

    c = fit(inside)
    done = False
    for _ in range(10 * k * k):
        descent = np.where(alive & bound & ~inside, b - g @ c, -np.inf)
        best = int(np.argmax(descent))
        if not descent[best] > TOLERANCE:
            done = True
            break
        inside[best] = True
        trial = fit(inside)
        if trial[best] <= 0:
            # rounding only: the term does not help
            inside[best] = False
            done = True
            break
        while (trial[inside & bound] <= 0).any():
            low = inside & bound & (trial <= 0)
            step = np.min(c[low] / (c[low] - trial[low]))
            c = c + step * (trial - c)
            inside &= ~(bound & (c <= 1e-15 * np.abs(c).max()))
            c[bound & ~inside] = 0.0
            trial = fit(inside)
        c = trial
    return c * change * size + 0.0, done


@dataclass(frozen=True)
class Penalties:
    """Assumptions about c: the squared miss of ``terms @ c`` against ``target`` costs ``weight``; where ``side`` is 1 only
    below the target, where it is -1 only above."""

    terms: np.ndarray
    target: np.ndarray
    weight: np.ndarray
    side: np.ndarray

    def active(self, c: np.ndarray) -> np.ndarray:
        return self._counts(self.terms @ c - self.target)

    def _counts(self, miss: np.ndarray) -> np.ndarray:
        return (self.side == 0) | (self.side * miss < 0)

    def add_to(self, g: np.ndarray, b: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weighted = self.terms[active] * self.weight[active, None]
        return g + weighted.T @ self.terms[active], b + weighted.T @ self.target[active]

    def step(self, g: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> float:
        """Where on the way from c to c + d the loss is smallest, from 0 to 1, exactly.

        Half its slope is linear between the points where an assumption starts or stops to be missed, and never falls.
        """
        miss, rate = self.terms @ c - self.target, self.terms @ d
        base, curve = d @ (g @ c - b), d @ g @ d

        def slope(at: float) -> float:
            now = miss + at * rate
            some = self._counts(now)
            return base + at * curve + (self.weight * rate * now)[some].sum()

        if slope(1.0) <= 0:
            return 1.0
        with np.errstate(divide="ignore", invalid="ignore"):
            turns = -miss / rate
        turns = np.concatenate([[0.0], np.sort(turns[(turns > 0) & (turns < 1)]), [1.0]])
        low, high = 0, len(turns) - 1
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if slope(turns[middle]) <= 0 else (low, middle)
        below, above = slope(turns[low]), slope(turns[high])
        return float(turns[low] + (turns[high] - turns[low]) * (-below / (above - below) if above > below else 0.0))


def solve_penalised(g: np.ndarray, b: np.ndarray, signs: list[int], penalties: Penalties) -> tuple[np.ndarray, bool]:
    """Minimise c'Gc - 2b'c plus the ``penalties``, with signs as in :func:`solve_signed`; also whether it ended.

    The loss is convex and quadratic between sets of missed assumptions. Each step solves for the present set and goes
    as far towards that solution as the loss falls, so it falls at every step and no set comes back.
    """
    held = penalties.side == 0
    c, done = solve_signed_status(*penalties.add_to(g, b, held), signs)
    most = 20 * (len(b) + 10)
    for _ in range(most):
        active = penalties.active(c)
        aim, done = solve_signed_status(*penalties.add_to(g, b, active), signs)
        if (penalties.active(aim) == active).all():
            return aim, done
        move = aim - c
        share = penalties.step(g, b, c, move)
        after = c + share * move
        if np.abs(after - c).max() <= 1e-14 * np.abs(after).max():
            return after, done
        c = after
    return c, False
