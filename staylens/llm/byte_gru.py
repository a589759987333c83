"""A bidirectional gated recurrent network over bytes in numpy: labels of every position, trained by backpropagation through time.

Arrays hold one window a column: bytes x (time, window) and mask alike (1 where a byte stands, windows fill from the front). Per
direction, with input columns W[:, byte] and recurrent weights U, rows in thirds (reset, update, candidate):
r, z = sigmoid(W + U h), n = tanh(W_n + r * U_n h), h' = n + z (h - n); padding holds h at zero. A position's label is a softmax over both states.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Network(NamedTuple):
    """Input (2, 3 H, 256) and recurrent (2, 3 H, H) weights of both directions, output (L, 2 H) weights and (L, 1) bias."""

    w: np.ndarray
    u: np.ndarray
    o: np.ndarray
    c: np.ndarray


class Steps(NamedTuple):
    """What the way back needs of a direction: states before each step, gates, candidates, and U_n h; by time."""

    before: np.ndarray
    gates: np.ndarray
    n: np.ndarray
    a_n: np.ndarray


def new_network(hidden: int, labels: int, rng: np.random.Generator) -> Network:
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[-1])).astype(np.float32)
    w = (rng.standard_normal((2, 3 * hidden, 256)) * 0.3).astype(np.float32)
    return Network(w, draw(2, 3 * hidden, hidden), draw(labels, 2 * hidden), np.zeros((labels, 1), np.float32))


def _order(length: int, direction: int) -> range:
    return range(length) if not direction else range(length - 1, -1, -1)


def _sigmoid_(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def states(net: Network, x: np.ndarray, mask: np.ndarray | None, direction: int, out: np.ndarray, steps: Steps | None = None) -> None:
    """Fills out (time, H, window) with one direction's states; without a mask every window is full."""
    w, u = net.w[direction], net.u[direction]
    hidden, n_windows = u.shape[1], x.shape[1]
    h = np.zeros((hidden, n_windows), np.float32)
    g, a = np.empty((3 * hidden, n_windows), np.float32), np.empty((3 * hidden, n_windows), np.float32)
    gates = np.empty((2 * hidden, n_windows), np.float32)
    for t in _order(len(x), direction):
        np.take(w, x[t], axis=1, out=g, mode="clip")
        np.matmul(u, h, out=a)
        np.add(g[: 2 * hidden], a[: 2 * hidden], out=gates)
        _sigmoid_(gates)
        n = gates[:hidden] * a[2 * hidden :]
        n += g[2 * hidden :]
        np.tanh(n, out=n)
        if steps is not None:
            steps.before[t], steps.gates[t], steps.n[t], steps.a_n[t] = h, gates, n, a[2 * hidden :]
        now = out[t]
        np.subtract(h, n, out=now)
        now *= gates[hidden:]
        now += n
        if mask is not None:
            now *= mask[t]
        h = now


def probabilities(net: Network, both: np.ndarray) -> np.ndarray:
    """(L, any) labels of states (2 H, any)."""
    p = net.o @ both
    p += net.c
    p -= p.max(axis=0)
    np.exp(p, out=p)
    p /= p.sum(axis=0)
    return p


def label_positions(net: Network, x: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
    """(L, time, window) probabilities of every position."""
    hidden = net.u.shape[2]
    both = np.empty((2, len(x), hidden, x.shape[1]), np.float32)
    for direction in (0, 1):
        states(net, x, mask, direction, both[direction])
    out = np.empty((len(net.c), *x.shape), np.float32)
    for t in range(len(x)):
        out[:, t] = probabilities(net, both[:, t].reshape(2 * hidden, -1))
    return out


def gradients(net: Network, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, Network]:
    """Mean cross entropy of the positions and its gradient, back through time."""
    length, n_windows = x.shape
    hidden, labels = net.u.shape[2], len(net.c)
    shape = (length, hidden, n_windows)
    both = np.empty((2, *shape), np.float32)
    kept = [Steps(np.empty(shape, np.float32), np.empty((length, 2 * hidden, n_windows), np.float32), *(np.empty(shape, np.float32) for _ in range(2))) for _ in range(2)]
    for direction in (0, 1):
        states(net, x, mask, direction, both[direction], kept[direction])
    flat = both.transpose(0, 2, 1, 3).reshape(2 * hidden, -1)
    weight = (mask / max(1.0, float(mask.sum()))).reshape(-1).astype(np.float32)
    p = probabilities(net, flat)
    column, of = np.arange(p.shape[1]), np.tile(label, length)
    loss = float(-(np.log(np.maximum(p[of, column], 1e-12)) * weight).sum())
    p[of, column] -= 1
    p *= weight
    d_both = (net.o.T @ p).reshape(2, hidden, length, n_windows).transpose(0, 2, 1, 3)
    grad = Network(np.zeros_like(net.w), np.zeros_like(net.u), p @ flat.T, p.sum(axis=1, keepdims=True).reshape(labels, 1))
    for direction in (0, 1):
        u, s = net.u[direction], kept[direction]
        dg = np.empty((3 * hidden, length, n_windows), np.float32)
        carried = np.zeros((hidden, n_windows), np.float32)
        for t in reversed(_order(length, direction)):
            dh = (d_both[direction, t] + carried) * mask[t]
            r, z, n, h = s.gates[t, :hidden], s.gates[t, hidden:], s.n[t], s.before[t]
            d_n = dh * (1 - z) * (1 - n * n)
            d_r = d_n * s.a_n[t] * r * (1 - r)
            d_z = dh * (h - n) * z * (1 - z)
            da = np.concatenate([d_r, d_z, d_n * r])
            dg[:hidden, t], dg[hidden : 2 * hidden, t], dg[2 * hidden :, t] = d_r, d_z, d_n
            grad.u[direction] += da @ h.T
            carried = dh * z + u.T @ da
        for row in range(3 * hidden):
            grad.w[direction, row] = np.bincount(x.reshape(-1), dg[row].reshape(-1), 256)
    return loss, grad


def train(x: np.ndarray, mask: np.ndarray, label: np.ndarray, labels: int, hidden: int, steps: int, batch: int, rate: float, seed: int) -> Network:
    """Adam over random batches of windows (columns of x), rates falling to zero; gradients are cut at norm 1."""
    rng = np.random.default_rng(seed)
    net = new_network(hidden, labels, rng)
    m, v = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net]
    order = rng.permutation(x.shape[1])
    at = 0
    for step in range(1, steps + 1):
        if at + batch > len(order):
            order, at = rng.permutation(x.shape[1]), 0
        own = order[at : at + batch]
        at += batch
        _, grad = gradients(net, x[:, own], mask[:, own], label[own])
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grad)))
        now = rate * (1 - (step - 1) / steps)
        for p, g, a, b in zip(net, grad, m, v, strict=True):
            g = g / max(1.0, norm)
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= (now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net
