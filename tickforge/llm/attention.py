"""A small causal self-attention model in numpy: forward, backward, training and batched scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 16
WIDTH = 16
NAMES = ("embed", "query", "key", "value", "out", "distance", "classes", "bias")
LOG10 = float(np.log(10))


@dataclass
class Model:
    """Weights by name.  Inputs are small integers, outputs log probabilities of classes.

    A text is dealt into blocks of ``BLOCK`` positions.  A position attends to itself and to what
    precedes it in its own block and the one before, so windows of two blocks overlap by
    one, and every position is scored once with at least a block of context where there is any.
    """

    weights: dict[str, np.ndarray]

    @staticmethod
    def start(inputs: int, classes: int, seed: int = 7) -> Model:
        rng = np.random.default_rng(seed)

        def noise(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        w = {"embed": noise(inputs, WIDTH, scale=0.3)}
        w |= {n: noise(WIDTH, WIDTH, scale=WIDTH ** -0.5) for n in ("query", "key", "value", "out")}
        w |= {"distance": np.zeros(2 * BLOCK, np.float32), "classes": noise(WIDTH, classes, scale=0.1),
              "bias": np.zeros(classes, np.float32)}
        return Model(w)

    def copy(self) -> Model:
        return Model({n: w.copy() for n, w in self.weights.items()})

    def flat(self) -> np.ndarray:
        return np.concatenate([self.weights[n].ravel() for n in NAMES])

    def with_flat(self, flat: np.ndarray) -> Model:
        out, at = {}, 0
        for n in NAMES:
            w = self.weights[n]
            out[n] = flat[at: at + w.size].reshape(w.shape).astype(np.float32)
            at += w.size
        return Model(out)


# Distance of key column j from query row i, and whether the key lies in the past.
_I, _J = np.arange(BLOCK)[:, None], np.arange(2 * BLOCK)[None, :]
DISTANCE = np.clip(BLOCK + _I - _J, 0, 2 * BLOCK - 1)
NEVER = np.float32(-1e9)
SAFE = 60.0
RUN_BLOCKS = 64
HIDDEN = np.where(_J > BLOCK + _I, NEVER, np.float32(0))


def blocks_of(sequences: list[np.ndarray], fill: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequences padded to whole blocks, and per block whether a block of the same sequence precedes it."""
    counts = np.array([-(-len(s) // BLOCK) for s in sequences])
    out = np.full(int(counts.sum()) * BLOCK, fill, np.int64)
    firsts = np.cumsum(counts) - counts
    for s, f in zip(sequences, firsts.tolist()):
        out[f * BLOCK: f * BLOCK + len(s)] = s
    follows = np.ones(int(counts.sum()), bool)
    follows[firsts[counts > 0]] = False
    return out.reshape(-1, BLOCK), follows


def _times(x, w):
    """A matrix applied to the last axis as one product, not one per block."""
    return (x.reshape(-1, x.shape[-1]) @ w).reshape(*x.shape[:-1], w.shape[1])


def _bounded(z) -> None:
    """Shifts rows by their maximum where an exponential could leave the range of numbers."""
    if z.max(initial=0) > SAFE or z.min(initial=0) < -SAFE:
        z -= z.max(-1, keepdims=True)


def _sums(x):
    """Sums over the last axis, kept as an axis, by a product with ones."""
    return (x.reshape(-1, x.shape[-1]) @ np.ones((x.shape[-1], 1), x.dtype)).reshape(*x.shape[:-1], 1)


def _attend(w, x, follows, before):
    """Attention over a run of blocks; ``before`` holds keys and values of the block ahead of the run."""
    q, own_k, own_v = (_times(x, w[n]) for n in ("query", "key", "value"))
    q *= np.float32(WIDTH ** -0.5)
    k, v = (np.concatenate([_past(own, b), own], axis=1) for own, b in zip((own_k, own_v), before))
    a = q @ k.transpose(0, 2, 1)
    a += w["distance"][DISTANCE]
    _bounded(a)
    a += HIDDEN
    a[~follows, :, :BLOCK] = NEVER
    np.exp(a, out=a)
    a /= _sums(a)
    o = a @ v
    return q, k, v, a, o, x + _times(o, w["out"]), (own_k[-1], own_v[-1])


def _exp_logits(w, h, targets):
    """Exponentials of the logits, their sums, and the log probability of each target."""
    z = h.reshape(-1, WIDTH) @ w["classes"]
    z += w["bias"]
    _bounded(z)
    rows = np.arange(len(z))
    picked = z[rows, np.maximum(targets.ravel(), 0)]
    np.exp(z, out=z)
    total = _sums(z)[:, 0]
    return z, total, picked - np.log(total), rows


def _past(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.concatenate([first[None], x[:-1]])


def class_log10(model: Model, ids: np.ndarray, follows: np.ndarray, targets: np.ndarray, at_once: int = RUN_BLOCKS) -> np.ndarray:
    """log10 probability of the target class at every position; 0 where the target is negative."""
    w = model.weights
    out = np.zeros(targets.shape)
    before = (np.zeros((BLOCK, WIDTH), w["embed"].dtype),) * 2
    for i in range(0, len(ids), at_once):
        part = slice(i, i + at_once)
        *_, h, before = _attend(w, w["embed"][ids[part]], follows[part], before)
        t = targets[part]
        out[part] = np.where(t >= 0, _exp_logits(w, h, t)[2].reshape(t.shape), 0)
    return out / LOG10


def gradients(model: Model, ids, follows, targets) -> tuple[float, int, dict[str, np.ndarray]]:
    """Summed negative log likelihood in nats, number of targets, gradient of their mean.

    The first block of the run has nothing before it.
    """
    w = model.weights
    follows = follows.copy()
    follows[:1] = False
    x = w["embed"][ids]
    q, k, v, a, o, h, _ = _attend(w, x, follows, (np.zeros((BLOCK, WIDTH), x.dtype),) * 2)
    dz, total, logs, rows = _exp_logits(w, h, targets)
    known = targets.ravel() >= 0
    n = int(known.sum())
    loss = -float(logs[known].sum())
    # From here on dz is the gradient of the mean loss by the logits.
    scale = np.where(known, np.float32(1 / max(n, 1)), np.float32(0))
    dz *= (scale / total)[:, None]
    dz[rows, np.maximum(targets.ravel(), 0)] -= scale
    g = {}

    def outer(left, right):
        return left.reshape(-1, left.shape[-1]).T @ right.reshape(-1, right.shape[-1])

    g["classes"], g["bias"] = outer(h, dz), dz.sum(0)
    dh = (dz @ w["classes"].T).reshape(h.shape)
    g["out"] = outer(o, dh)
    do = _times(dh, w["out"].T)
    ds = do @ v.transpose(0, 2, 1)
    dv = a.transpose(0, 2, 1) @ do
    # The weighted mean of ds under the attention is do . o, row by row.
    ds -= (do * o).sum(2, keepdims=True)
    ds *= a
    g["distance"] = np.bincount(DISTANCE.ravel(), ds.sum(0).ravel(), 2 * BLOCK).astype(x.dtype)
    dq = (ds @ k) * np.float32(WIDTH ** -0.5)
    dk = ds.transpose(0, 2, 1) @ q
    # A block's keys and values serve itself and the block after it.
    own_k, own_v = (_own(d) for d in (dk, dv))
    g["query"], g["key"], g["value"] = outer(x, dq), outer(x, own_k), outer(x, own_v)
    dx = dh + _times(dq, w["query"].T)
    dx += _times(own_k, w["key"].T)
    dx += _times(own_v, w["value"].T)
    g["embed"] = _rows_added(ids.ravel(), dx.reshape(-1, WIDTH), len(w["embed"]))
    return loss, n, g


def _own(d: np.ndarray) -> np.ndarray:
    """Gradient of each block's own keys or values, from those of the pairs of blocks.

    Attention to a block that does not precede is zero, and so is its gradient.
    """
    own = d[:, BLOCK:].copy()
    own[:-1] += d[1:, :BLOCK]
    return own


def _rows_added(ids: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Rows summed by id."""
    width = rows.shape[1]
    cells = (ids * width)[:, None] + np.arange(width)
    return np.bincount(cells.ravel(), rows.ravel(), size * width).astype(rows.dtype).reshape(size, width)


class Adam:
    """Adam with a rate that falls with the number of steps."""

    def __init__(self, model: Model, rate: float = 0.01):
        # All weights lie in one array, of which the model's are views.
        self.flat, self.rate, self.step = model.flat(), rate, 0
        self.model, at = Model({}), 0
        for n in NAMES:
            w = model.weights[n]
            self.model.weights[n] = self.flat[at: at + w.size].reshape(w.shape)
            at += w.size
        self.m, self.v = np.zeros_like(self.flat), np.zeros_like(self.flat)

    def learn(self, ids, follows, targets) -> tuple[float, int]:
        """One step; its blocks are worked off in runs that stay in the processor's cache."""
        loss, n, g = 0.0, 0, 0
        for i in range(0, len(ids), RUN_BLOCKS):
            run = slice(i, i + RUN_BLOCKS)
            part, k, slope = gradients(self.model, ids[run], follows[run], targets[run])
            loss, n = loss + part, n + k
            flat = Model(slope).flat()
            flat *= k
            g = g + flat
        if not n:
            return loss, n
        g /= n
        self.step += 1
        rate = self.rate / (1 + self.step / 200) ** 0.5
        self.m += 0.1 * (g - self.m)
        g *= g
        g -= self.v
        g *= 0.01
        self.v += g
        scale = np.sqrt(self.v / (1 - 0.99 ** self.step))
        scale += 1e-8
        move = self.m / (1 - 0.9 ** self.step)
        move *= rate
        move /= scale
        self.flat -= move
        return loss, n
