"""A bidirectional gated recurrent network with attention pooling, for two classes, in numpy: forward, backward, Adam."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def new_network(inputs: int, hidden: int, seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def weights(a: int, b: int) -> np.ndarray:
        return (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)

    net = {}
    for way in "fb":
        net |= {f"W{way}": weights(inputs, 3 * hidden), f"U{way}": weights(hidden, 3 * hidden),
                f"b{way}": np.zeros(3 * hidden, np.float32)}
    return net | {"A": weights(2 * hidden, hidden), "c": np.zeros(hidden, np.float32), "v": weights(hidden, 1)[:, 0],
                  "o": weights(2 * hidden, 1)[:, 0], "k": np.zeros(1, np.float32)}


def _run(a: list[np.ndarray], u: np.ndarray, mask: np.ndarray, order: range, keep: bool):
    """States of one direction; ``a[t]`` is the input's part of the gates (update, reset, new) at step t."""
    hidden = u.shape[0]
    h = np.zeros((len(mask), hidden), np.float32)
    states, saved = [None] * len(order), []
    for t in order:
        before, part = h, h @ u
        gates = _sigmoid(a[t][:, :2 * hidden] + part[:, :2 * hidden])
        z, r, q = gates[:, :hidden], gates[:, hidden:], part[:, 2 * hidden:]
        n = np.tanh(a[t][:, 2 * hidden:] + r * q)
        m = mask[:, t, None]
        h = before + m * (1 - z) * (n - before)
        states[t] = h
        if keep:
            saved.append((t, before, z, r, q, n, m))
    return states, saved


def logits(net: dict, gates: np.ndarray, index: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Log odds of each window. ``gates`` holds, per distinct word, the inputs' part for both directions side by side;
    ``index`` (windows x steps) points into it, ``mask`` is 1 where a window has a word. Steps without one change nothing.
    """
    steps, hidden = index.shape[1], net["A"].shape[1]
    half = 3 * hidden
    given = [gates[index[:, t]] for t in range(steps)]
    forth, saved_f = _run([g[:, :half] for g in given], net["Uf"], mask, range(steps), keep)
    back, saved_b = _run([g[:, half:] for g in given], net["Ub"], mask, range(steps - 1, -1, -1), keep)
    h = np.concatenate([np.stack(forth, 1), np.stack(back, 1)], 2)
    t = np.tanh(h @ net["A"] + net["c"])
    s = np.where(mask > 0, t @ net["v"], -1e9)
    e = np.exp(s - s.max(1, keepdims=True)) * mask
    weight = e / np.maximum(e.sum(1, keepdims=True), 1e-9)
    context = np.einsum("bt,bth->bh", weight, h)
    out = context @ net["o"] + net["k"][0]
    return (out, (h, t, weight, context, saved_f, saved_b, given)) if keep else out


def gradients(net: dict, x: np.ndarray, index: np.ndarray, mask: np.ndarray, y: np.ndarray, w: np.ndarray):
    """Mean weighted logistic loss of windows, its gradients by parameter, and those by the rows of ``x``."""
    gates = np.concatenate([x @ net["Wf"] + net["bf"], x @ net["Wb"] + net["bb"]], 1)
    out, (h, t, weight, context, saved_f, saved_b, _) = logits(net, gates, index, mask, True)
    hidden = net["A"].shape[1]
    loss = float((w * (np.logaddexp(0, out) - y * out)).mean())
    d_out = (w * (_sigmoid(out) - y) / len(y)).astype(np.float32)
    g = {"o": context.T @ d_out, "k": np.array([d_out.sum()], np.float32)}
    d_context = d_out[:, None] * net["o"]
    d_weight = np.einsum("bh,bth->bt", d_context, h)
    d_h = weight[:, :, None] * d_context[:, None]
    d_s = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
    g["v"] = np.einsum("bt,bth->h", d_s, t)
    d_t = d_s[:, :, None] * net["v"] * (1 - t * t)
    g["c"], g["A"] = d_t.sum((0, 1)), np.einsum("bth,btk->hk", h, d_t)
    d_h += d_t @ net["A"].T
    d_steps = np.zeros((index.shape[1], len(y), 6 * hidden), np.float32)
    for way, saved, part, column in (("f", saved_f, d_h[:, :, :hidden], 0), ("b", saved_b, d_h[:, :, hidden:], 3 * hidden)):
        u = net[f"U{way}"]
        g[f"U{way}"], later = np.zeros_like(u), np.zeros((len(y), hidden), np.float32)
        for step, before, z, r, q, n, m in reversed(saved):
            d = part[:, step] + later
            own = d * m
            d_n = own * (1 - z) * (1 - n * n)
            d_z = own * (before - n) * z * (1 - z)
            d_r = d_n * q * r * (1 - r)
            recurrent = np.concatenate([d_z, d_r, d_n * r], 1)
            g[f"U{way}"] += before.T @ recurrent
            later = d * (1 - m) + own * z + recurrent @ u.T
            d_steps[step, :, column:column + 3 * hidden] = np.concatenate([d_z, d_r, d_n], 1)
    # sums over the steps that read the same word
    at = index.T.ravel()
    order = np.argsort(at, kind="stable")
    found, first = np.unique(at[order], return_index=True)
    d_gates = np.zeros_like(gates)
    d_gates[found] = np.add.reduceat(d_steps.reshape(len(at), -1)[order], first, axis=0)
    for way, column in (("f", 0), ("b", 3 * hidden)):
        own = d_gates[:, column:column + 3 * hidden]
        g[f"W{way}"], g[f"b{way}"] = x.T @ own, own.sum(0)
    d_x = d_gates[:, :3 * hidden] @ net["Wf"].T + d_gates[:, 3 * hidden:] @ net["Wb"].T
    return loss, g, d_x


class Adam:
    def __init__(self, rate: float = 0.01):
        self.rate, self.turn, self.state = rate, 0, {}

    def step(self, parameters: dict[str, np.ndarray], gradient: dict[str, np.ndarray]) -> None:
        self.turn += 1
        for k, g in gradient.items():
            m, v = self.state.setdefault(k, (np.zeros_like(parameters[k]), np.zeros_like(parameters[k])))
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            parameters[k] -= (self.rate * (m / (1 - 0.9 ** self.turn)) / (np.sqrt(v / (1 - 0.999 ** self.turn)) + 1e-8)).astype(np.float32)
