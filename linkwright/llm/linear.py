"""Logistic regression over sparse rows, in numpy, for bounded samples on the driver."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Rows:
    """Sparse rows (flat columns and values with row starts) and a few dense columns."""

    cols: np.ndarray
    vals: np.ndarray
    starts: np.ndarray  # one more than rows
    dense: np.ndarray
    width: int

    def __len__(self) -> int:
        return len(self.starts) - 1

    def take(self, rows: np.ndarray) -> Rows:
        lens = np.diff(self.starts)[rows]
        starts = np.concatenate([[0], np.cumsum(lens)])
        flat = np.repeat(self.starts[:-1][rows] - starts[:-1], lens) + np.arange(starts[-1])
        return Rows(self.cols[flat], self.vals[flat], starts, self.dense[rows], self.width)

    def with_dense(self, column: np.ndarray) -> Rows:
        return Rows(self.cols, self.vals, self.starts, np.column_stack([self.dense, column]), self.width)

    def dot(self, w: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.vals * w[self.cols])])
        return sums[self.starts[1:]] - sums[self.starts[:-1]] + self.dense @ w[self.width :]

    def dot_t(self, r: np.ndarray) -> np.ndarray:
        each = np.repeat(r, np.diff(self.starts))
        return np.concatenate([np.bincount(self.cols, self.vals * each, self.width), r @ self.dense])


def sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -35, 35)))


def fit_logistic(x: Rows, y: np.ndarray, l2: float = 1.0, rounds: int = 60, memory: int = 8) -> tuple[np.ndarray, float]:
    """(weights, intercept) of least penalised log loss, by L-BFGS with backtracking."""
    n = x.width + x.dense.shape[1]
    w = np.zeros(n + 1)
    share = np.clip(y.mean() if len(y) else 0.5, 1e-4, 1 - 1e-4)
    w[-1] = np.log(share / (1 - share))

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        v = np.clip(x.dot(w[:-1]) + w[-1], -35, 35)
        r = sigmoid(v) - y
        f = float(np.logaddexp(0, v).sum() - (y * v).sum() + 0.5 * l2 * (w[:-1] @ w[:-1]))
        return f, np.concatenate([x.dot_t(r) + l2 * w[:-1], [r.sum()]])

    f, g = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, tried = g.copy(), []
        for s, d in reversed(past):
            a = (s @ q) / (s @ d)
            q -= a * d
            tried.append(a)
        q *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.abs(g).max())
        for (s, d), a in zip(past, reversed(tried), strict=True):
            q += s * (a - (d @ q) / (s @ d))
        slope, step = g @ q, 1.0
        while True:
            f2, g2 = loss(w - step * q)
            if f2 <= f - 1e-4 * step * slope or step < 1e-6:
                break
            step /= 2
        s, d = -step * q, g2 - g
        done = f - f2 < 1e-5 * max(1.0, abs(f))
        w, f, g = w + s, f2, g2
        if s @ d > 1e-12:
            past = [*past[-memory + 1 :], (s, d)]
        if done:
            break
    return w[:-1], float(w[-1])
