"""Two-state linear-chain conditional random field over one long concatenated chain.

Every text is a piece of the chain; at its first position the transition matrix is replaced by one with equal rows, which
forgets what came before. So a whole block of texts of any lengths is one forward-backward pass, cut into equal columns
that advance together."""

from __future__ import annotations

import numpy as np

WIDTH = 96


def _potentials(e1, first, trans, start):
    """exp-potentials m[s][s'] of each position; state 0 has emission 0, state 1 has e1, both scaled by their maximum."""
    top = np.maximum(e1, 0.0)
    g0, g1 = np.exp(-top), np.exp(e1 - top)
    t, s = np.exp(trans - trans.max()), np.exp(start - start.max())
    return (
        np.where(first, s[0], t[0, 0]) * g0, np.where(first, s[1], t[0, 1]) * g1,
        np.where(first, s[0], t[1, 0]) * g0, np.where(first, s[1], t[1, 1]) * g1,
    )


def marginals(e1: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray, pairs: bool = False):
    """P(state 1) at every position and, if asked, expected transition counts (2, 2) within texts."""
    n = len(e1)
    if not n:
        return (np.zeros(0), np.zeros((2, 2))) if pairs else np.zeros(0)
    rows = -(-n // WIDTH)
    pad = rows * WIDTH - n
    m = [np.pad(x, (0, pad), constant_values=c).reshape(rows, WIDTH).T.copy() for x, c in zip(_potentials(e1, first, trans, start), (1.0, 0.0, 0.0, 1.0))]
    a, b, c, d = m
    # the product of each column's matrices
    p00, p01, p10, p11 = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
    for j in range(WIDTH):
        p00, p01, p10, p11 = p00 * a[j] + p01 * c[j], p00 * b[j] + p01 * d[j], p10 * a[j] + p11 * c[j], p10 * b[j] + p11 * d[j]
        z = 1.0 / np.maximum(p00 + p01 + p10 + p11, 1e-300)
        p00, p01, p10, p11 = p00 * z, p01 * z, p10 * z, p11 * z
    head, tail = np.empty((rows, 2)), np.empty((rows, 2))
    x, y = 0.5, 0.5
    for r, (q00, q01, q10, q11) in enumerate(zip(p00.tolist(), p01.tolist(), p10.tolist(), p11.tolist())):
        head[r] = x, y
        x, y = x * q00 + y * q10, x * q01 + y * q11
        z = x + y or 1.0
        x, y = x / z, y / z
    x, y = 0.5, 0.5
    for r in range(rows - 1, -1, -1):
        tail[r] = x, y
        x, y = p00[r] * x + p01[r] * y, p10[r] * x + p11[r] * y
        z = x + y or 1.0
        x, y = x / z, y / z
    f0, f1 = np.empty((WIDTH, rows)), np.empty((WIDTH, rows))
    x, y = head[:, 0], head[:, 1]
    for j in range(WIDTH):
        x, y = x * a[j] + y * c[j], x * b[j] + y * d[j]
        z = 1.0 / np.maximum(x + y, 1e-300)
        x, y = x * z, y * z
        f0[j], f1[j] = x, y
    b0, b1 = np.empty((WIDTH, rows)), np.empty((WIDTH, rows))
    x, y = tail[:, 0], tail[:, 1]
    for j in range(WIDTH - 1, -1, -1):
        b0[j], b1[j] = x, y
        x, y = a[j] * x + b[j] * y, c[j] * x + d[j] * y
        z = 1.0 / np.maximum(x + y, 1e-300)
        x, y = x * z, y * z
    p1 = f1 * b1
    p1 /= np.maximum(p1 + f0 * b0, 1e-300)
    flat = lambda w: w.T.reshape(-1)[:n]
    if not pairs:
        return flat(p1)
    f0, f1, b0, b1, a, b, c, d = map(flat, (f0, f1, b0, b1, a, b, c, d))
    if n == 1:
        return flat(p1), np.zeros((2, 2))
    x = [f0[:-1] * a[1:] * b0[1:], f0[:-1] * b[1:] * b1[1:], f1[:-1] * c[1:] * b0[1:], f1[:-1] * d[1:] * b1[1:]]
    z = np.maximum(sum(x), 1e-300)
    inner = ~first[1:]
    return flat(p1), np.array([(v / z)[inner].sum() for v in x]).reshape(2, 2)


class ChainCRF:
    """Linear emissions for state 1 over standardised features, 2x2 transitions, start weights; L2-regularised maximum likelihood by Adam."""

    def __init__(self, l2: float = 1e-3, steps: int = 250, rate: float = 0.08):
        self.l2, self.steps, self.rate = l2, steps, rate

    def fit(self, x: np.ndarray, y: np.ndarray, first: np.ndarray) -> ChainCRF:
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        z = (x - self.mean) / self.scale
        n, k = z.shape
        y = y.astype(float)
        theta = np.zeros(k + 1 + 4 + 2)
        inner = ~first[1:]
        code = (2 * y[:-1] + y[1:]).astype(int)[inner]
        seen = np.bincount(code, minlength=4).astype(float)
        at_start = np.array([(1 - y[first]).sum(), y[first].sum()])
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for i in range(1, self.steps + 1):
            w, b, t, s = theta[:k], theta[k], theta[k + 1 : k + 5].reshape(2, 2), theta[k + 5 :]
            p, xi = marginals(z @ w + b, first, t, s, pairs=True)
            g = np.concatenate((z.T @ (p - y), [(p - y).sum()], xi.reshape(-1) - seen, np.array([(1 - p[first]).sum(), p[first].sum()]) - at_start)) / n + self.l2 * theta
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            theta = theta - self.rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
        self.w, self.b, self.trans, self.start = theta[:k], theta[k], theta[k + 1 : k + 5].reshape(2, 2), theta[k + 5 :]
        return self

    def predict(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return marginals(((x - self.mean) / self.scale) @ self.w + self.b, first, self.trans, self.start)
