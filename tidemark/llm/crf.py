"""A linear-chain conditional random field with two states, as array operations.

With two states a message is one number, the ratio of its two entries.  A message
depends on the one before it through a contraction, so all messages of all chains are
updated at once, then only those whose neighbour still changed, until none does.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_CLIP = 30.0


def _messages(gain: np.ndarray, first: np.ndarray, t: np.ndarray) -> np.ndarray:
    """r[i] = gain[i] * (t01 + t11 r[i-1]) / (t00 + t10 r[i-1]); r = gain where a chain begins."""
    n = len(gain)
    r = gain.copy()
    todo = np.flatnonzero(~first)
    for _ in range(n + 1):
        if not len(todo):
            break
        before = r[todo - 1]
        new = gain[todo] * (t[0, 1] + t[1, 1] * before) / (t[0, 0] + t[1, 0] * before)
        moved = np.abs(new - r[todo]) > 1e-9 * new + 1e-300
        r[todo] = new
        todo = todo[moved] + 1
        todo = todo[todo < n]
        todo = todo[~first[todo]]
    return r


@dataclass
class Posterior:
    marginal: np.ndarray
    forward: np.ndarray
    backward: np.ndarray


def forward_backward(u: np.ndarray, first: np.ndarray, t: np.ndarray) -> Posterior:
    """P(state 1) of each position, for scores u of state 1 over 0 and transition factors t."""
    if not len(u):
        return Posterior(u, u, u)
    gain = np.exp(np.clip(u, -_CLIP, _CLIP))
    r = _messages(gain, first, t)
    last = np.append(first[1:], True)
    # q[i] = gain[i] * b[i] runs backwards with the transposed factors
    q = _messages(gain[::-1], last[::-1], t.T)[::-1]
    b = q / gain
    odds = r * b
    return Posterior(odds / (1 + odds), r, b)


def pair_counts(u: np.ndarray, first: np.ndarray, t: np.ndarray, p: Posterior) -> np.ndarray:
    """Expected transitions."""
    at = np.flatnonzero(~first)
    r, q = p.forward[at - 1], np.exp(np.clip(u[at], -_CLIP, _CLIP)) * p.backward[at]
    x = np.stack([np.full(len(at), t[0, 0]), t[0, 1] * q, r * t[1, 0], r * t[1, 1] * q])
    return (x / x.sum(0)).sum(1).reshape(2, 2)


def train(feats: np.ndarray, values: np.ndarray | None, size: int, y: np.ndarray, first: np.ndarray, weight: np.ndarray, rounds: int = 60, l2: float = 1e-6, rate: float = 0.3, fixed: int | None = None, bias: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(feature weights, log transition factors) by Adam on the conditional likelihood.

    feats: (k, n) feature indices of each position, with values (k, n) or 1.
    fixed: a feature whose weight stays 0.  bias: the feature that every position has; it begins
    at the log odds of the labels.
    """
    w, a = np.zeros(size), np.zeros((2, 2))
    if bias is not None:
        w[bias] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(a), np.zeros_like(a)]
    at = np.flatnonzero(~first)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[at - 1], y[at]), 1.0)
    total = weight.sum()
    for step in range(1, rounds + 1):
        u = np.zeros(len(y))
        for j in range(len(feats)):
            u += w[feats[j]] if values is None else w[feats[j]] * values[j]
        t = np.exp(a)
        p = forward_backward(u, first, t)
        err = (y - p.marginal) * weight
        g = np.zeros(size)
        for j in range(len(feats)):
            g += np.bincount(feats[j], err if values is None else err * values[j], size)
        if fixed is not None:
            g[fixed] = 0
        ga = (seen - pair_counts(u, first, t, p)) * (total / max(1, len(y)))
        for x, grad, m, v in ((w, g / total - l2 * w, state[0], state[1]), (a, ga / total - l2 * a, state[2], state[3])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            x += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        np.clip(a, -4, 4, out=a)
    return w, a


def platt(z: np.ndarray, y: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """(slope, offset) of a logistic fit, by Newton steps with a little shrinkage; targets are smoothed."""
    n1, n0 = y.sum(), len(y) - y.sum()
    goal = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -_CLIP, _CLIP)))
        s = p * (1 - p)
        g = np.array([((goal - p) * z).sum() - 1e-3 * a, (goal - p).sum()])
        h = np.array([[(s * z * z).sum() + 1e-3, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-9]])
        step = np.linalg.solve(h + 1e-9 * np.eye(2), g)
        step = np.clip(step, -2, 2)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -_CLIP, _CLIP)))
