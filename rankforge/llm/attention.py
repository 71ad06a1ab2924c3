"""A small causal attention model over subword ids, in numpy.

Texts are cut into chunks. A window is a chunk and the one before it: each
position of a chunk attends to all of the window up to itself, by one head with a
bias for each distance, so that every subword is predicted once, from at least a
chunk of context. A residual connection and a feed-forward layer follow.

The next subword is chosen on a tree of three levels of 16 branches, each by a
softmax that sees the context. Branches have equal mass in the training counts.
Subwords that share a leaf are told apart by their counts alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cache

import numpy as np

WIDTH, LEVELS = 16, 3
_NODES = sum(WIDTH ** i for i in range(LEVELS))
_FIRST = [sum(WIDTH ** i for i in range(level)) for level in range(LEVELS)]  # node of each level
_UNUSED = -60.0
_PART = 128  # chunks
_FEW = 4  # blocks of a node, at most, that are summed up one by one


@dataclass(frozen=True)
class ModelParams:
    smoothing: float = 0.1
    inputs: int = 2048  # frequent subwords with a vector of their own; the others share one per two levels
    dim: int = 16
    hidden: int = 32
    chunk: int = 16
    batch: int = 256  # chunks of a training step
    rate: float = 0.15
    seed: int = 3


def coding(counts: np.ndarray, params: ModelParams) -> dict:
    """Per subword id its leaf, its log-probability in the leaf and its input;
    per node the logarithms of its branches' shares. One input more stands for
    what lies before a text."""
    smooth = counts + params.smoothing
    order = np.argsort(-smooth, kind="stable")
    leaf = np.zeros(len(counts), np.int64)
    for _ in range(LEVELS):
        # bins of equal mass of each node, whose subwords follow each other
        mass, node = smooth[order], leaf[order]
        cuts = np.flatnonzero(np.diff(node, prepend=-1))
        length = np.diff(np.append(cuts, len(node)))
        before = np.cumsum(mass) - mass / 2
        total = np.add.reduceat(mass, cuts)
        start = np.cumsum(total) - total
        share = (before - np.repeat(start, length)) / np.repeat(total, length)
        leaf[order] = node * WIDTH + np.clip((share * WIDTH).astype(np.int64), 0, WIDTH - 1)
    mass = np.bincount(leaf, smooth, minlength=WIDTH ** LEVELS)
    prior = np.full((_NODES, WIDTH), _UNUSED, np.float32)
    for level in range(LEVELS):
        own = mass.reshape(WIDTH ** level, WIDTH, -1).sum(axis=2)
        whole = own.sum(axis=1, keepdims=True)
        share = np.divide(own, whole, out=np.zeros_like(own), where=whole > 0)
        prior[_FIRST[level]:_FIRST[level] + len(own)] = np.log(share, out=np.full_like(own, _UNUSED), where=share > 0)
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    shared = params.inputs + leaf // WIDTH
    return {"leaf": leaf.astype(np.int32), "in_leaf": np.log(smooth / mass[leaf]), "prior": prior,
            "input": np.where(rank < params.inputs, rank, shared).astype(np.int32),
            "before": params.inputs + WIDTH ** (LEVELS - 1)}


def initial(params: ModelParams) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(params.seed)
    d, h = params.dim, params.hidden

    def normal(*shape, scale):
        return rng.normal(0, scale, shape).astype(np.float32)

    return {"E": normal(params.inputs + WIDTH ** (LEVELS - 1) + 1, d, scale=0.5),
            "P": np.hstack([normal(d, 2 * d, scale=d ** -0.5), normal(d, d, scale=0.5 * d ** -0.5)]),
            "R": np.zeros(2 * params.chunk, np.float32),
            "W1": normal(d, h, scale=d ** -0.5), "b1": np.zeros(h, np.float32), "W2": normal(h, d, scale=0.5 * h ** -0.5),
            # what the context adds to the shares of the branches, and a constant: nothing yet
            "O": np.zeros((_NODES, d, WIDTH), np.float32), "o": np.zeros((_NODES, WIDTH), np.float32)}


@cache
def _distance(chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """Distance of every position of a chunk to those of its window, and which
    of these lie after it."""
    distance = np.arange(chunk)[:, None] + chunk - np.arange(2 * chunk)[None, :]
    return np.maximum(distance, 0), distance < 0


def chunks(ids: np.ndarray, starts: np.ndarray, code: dict, chunk: int):
    """Inputs by chunk, a chunk of what lies before each text first; the ids to
    predict (-1: none); and the first chunk of each text, with the end."""
    lengths = np.diff(starts)
    per = -(-lengths // chunk) + 1
    first = np.concatenate(([0], np.cumsum(per)))
    inputs = np.full(first[-1] * chunk, code["before"], np.int32)
    target = np.full(first[-1] * chunk, -1, np.int32)
    at = np.arange(len(ids)) + np.repeat((first[:-1] + 1) * chunk - starts[:-1], lengths)
    target[at] = ids
    # a subword is the input of the next place; the last one of a text is the end
    inner = np.ones(len(ids), bool)
    inner[starts[1:] - 1] = False
    inputs[at[inner] + 1] = code["input"][ids[inner]]
    return inputs.reshape(-1, chunk), target.reshape(-1, chunk), first


def _flat(t: np.ndarray) -> np.ndarray:
    return t.reshape(-1, t.shape[-1])


def _sums(t: np.ndarray) -> np.ndarray:
    return np.ones(len(t), t.dtype) @ t


def _projection(p: dict) -> np.ndarray:
    """``P`` with the scale of the products in its queries."""
    d = p["E"].shape[1]
    return np.hstack([p["P"][:, :d] * p["P"].dtype.type(1 / math.sqrt(d)), p["P"][:, d:]])


def _windows(rows: np.ndarray, low: int, d: int) -> np.ndarray:
    """``d`` columns of the rows of every chunk but the first, after those of
    the chunk before it; a view."""
    n, chunk, _ = rows.shape
    return np.ndarray((n - 1, 2 * chunk, d), rows.dtype, rows, low * rows.itemsize, rows.strides)


def _turned(weights: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The windows of ``x @ weights``, columns first: small products are faster
    on these."""
    n, chunk, _ = x.shape
    columns = weights.T @ _flat(x).T
    step = columns.itemsize
    return np.ndarray((n - 1, len(columns), 2 * chunk), columns.dtype, columns, 0, (chunk * step, columns.strides[0], step))


def _attend(p: dict, projection: np.ndarray, inputs: np.ndarray):
    """State of every position but those of the first chunk, which is context
    only, and what the way back needs."""
    d = p["E"].shape[1]
    chunk = inputs.shape[1]
    distance, later = _distance(chunk)
    x = p["E"].take(inputs, axis=0)
    qkv = (_flat(x) @ projection).reshape(*inputs.shape, 3 * d)
    a = qkv[1:, :, :d] @ _turned(projection[:, d:2 * d], x)
    a += np.where(later, x.dtype.type(_UNUSED), p["R"][distance])
    if a.max() > 60:  # no overflow; never reached by a trained model
        np.minimum(a, 60, out=a)
    np.exp(a, out=a)
    share = (1 / (_flat(a) @ np.ones(2 * chunk, x.dtype)))[:, None]
    h = a @ _windows(qkv, 2 * d, d)
    mean = _flat(h)
    mean *= share
    h = mean + _flat(x)[chunk:]
    r = h @ p["W1"]
    r += p["b1"]
    np.maximum(r, 0, out=r)
    g = r @ p["W2"]
    g += h
    return g, (x, qkv, a, share, mean, h, r)


def _back(p: dict, projection: np.ndarray, inputs: np.ndarray, kept: tuple, dg: np.ndarray):
    """Gradients by every input and by the parameters of attention, from those
    by the states."""
    x, qkv, a, share, mean, h, r = kept
    d, chunk = p["E"].shape[1], inputs.shape[1]
    dz = dg @ p["W2"].T
    dz *= r > 0
    dh = dz @ p["W1"].T
    dh += dg
    # a has no share yet
    own = dh * share
    mean *= own
    by_window = own.reshape(len(a), chunk, d)
    ds = by_window @ _turned(projection[:, 2 * d:], x)
    ds -= (mean @ np.ones(d, x.dtype)).reshape(len(a), chunk, 1)
    ds *= a
    d_qkv = np.empty_like(qkv)
    d_qkv[0, :, :d] = 0
    np.matmul(ds, _windows(qkv, d, d), out=d_qkv[1:, :, :d])
    for low, to_window in ((d, ds.transpose(0, 2, 1) @ qkv[1:, :, :d]), (2 * d, a.transpose(0, 2, 1) @ by_window)):
        d_qkv[0, :, low:low + d] = to_window[0, :chunk]
        np.add(to_window[1:, :chunk], to_window[:-1, chunk:], out=d_qkv[1:-1, :, low:low + d])
        d_qkv[-1, :, low:low + d] = to_window[-1, chunk:]
    d_qkv = _flat(d_qkv)
    dx = d_qkv @ projection.T
    dx[chunk:] += dh
    dp = _flat(x).T @ d_qkv
    dp[:, :d] *= x.dtype.type(1 / math.sqrt(d))
    distance, later = _distance(chunk)
    by_place = _sums(ds.reshape(len(ds), -1)).reshape(later.shape)
    dr = np.bincount(distance.ravel(), np.where(later, 0, by_place).ravel(), minlength=2 * chunk)
    return dx, {"P": dp, "R": dr.astype(x.dtype), "W1": h.T @ dz, "b1": _sums(dz), "W2": r.T @ dg}


class _Branches:
    """The softmax of every level for some states, whose leaves are known.

    States are sorted by node of the last level and laid out in blocks of rows
    of one node, with empty rows at the end of a node, so that this level is one
    batch of small products; those of any other node follow each other. States
    end in a one, whose weights are the node's constants. ``log`` has the
    log-probabilities of the leaves."""

    def __init__(self, weights: np.ndarray, states: np.ndarray, leaf: np.ndarray):
        self.weights, n = weights, len(states)
        last = WIDTH ** (LEVELS - 1)
        self.rows = rows = max(8, min(64, n // (2 * last)))
        node = (leaf // WIDTH).astype(np.uint16)
        order = np.argsort(node, kind="stable")
        size = np.bincount(node, minlength=last)
        blocks = -(-size // rows)
        high = np.cumsum(blocks)
        self.begin, self.blocks, self.nodes = high - blocks, blocks, np.repeat(np.arange(last), blocks)
        at = np.arange(n) + np.repeat(self.begin * rows - np.cumsum(size) + size, size)
        self.place = np.empty(n, np.int64)
        self.place[order] = at
        m = len(self.nodes) * rows
        source = np.full(m, n)
        source[self.place] = np.arange(n)
        ended = np.zeros((n + 1, states.shape[1] + 1), states.dtype)
        ended[:n, :-1], ended[:n, -1] = states, 1
        self.states = padded = ended.take(source, axis=0)
        # (level, node, its first row, the one after its last) of the levels before the last
        self.parts = []
        for level in range(LEVELS - 1):
            ends = (high[last // WIDTH ** level - 1::last // WIDTH ** level] * rows).tolist()
            self.parts += [(level, _FIRST[level] + i, low, end) for i, (low, end) in enumerate(zip([0, *ends], ends)) if end > low]
        self.own = weights[_FIRST[-1]:].take(self.nodes, axis=0)
        logits = np.empty((LEVELS, m, WIDTH), states.dtype)
        for level, i, low, end in self.parts:
            np.dot(padded[low:end], weights[i], logits[level, low:end])
        np.matmul(self._blocks(padded), self.own, out=self._blocks(logits[-1]))
        if logits.max() > 60 or logits.min() < -80:
            np.clip(logits, -60, 60, out=logits)
        # of every level and state, the branch that leads to its leaf
        down = WIDTH ** np.arange(LEVELS - 1, -1, -1)[:, None]
        self.taken = (np.arange(LEVELS)[:, None] * m + self.place) * WIDTH + leaf // down % WIDTH
        picked = logits.ravel().take(self.taken)
        np.exp(logits, out=logits)
        self.share, self.total = logits, _flat(logits) @ np.ones(WIDTH, states.dtype)
        total = np.log(self.total).reshape(LEVELS, m).take(self.place, axis=1)
        self.log = (picked - total).sum(axis=0, dtype=np.float64)

    def _blocks(self, t: np.ndarray) -> np.ndarray:
        return t.reshape(len(self.nodes), self.rows, t.shape[-1])

    def back(self) -> tuple[np.ndarray, np.ndarray]:
        """Gradients, by states and weights, of the mean of -log."""
        n, share = len(self.place), self.share
        flat = _flat(share)
        flat *= (1 / (n * self.total))[:, None]
        flat.ravel()[self.taken] -= share.dtype.type(1 / n)
        by_weight = np.zeros_like(self.weights)
        turned = np.ascontiguousarray(self.weights[:, :-1].transpose(0, 2, 1))
        last = self._blocks(share[-1])
        by_state = _flat(last @ turned[_FIRST[-1]:].take(self.nodes, axis=0))
        for level, i, low, end in self.parts:
            now = share[level, low:end]
            np.dot(self.states[low:end].T, now, by_weight[i])
            by_state[low:end] += now @ turned[i]
        few = self.blocks <= _FEW
        for node in np.flatnonzero(~few):
            rows = slice(self.begin[node] * self.rows, (self.begin[node] + self.blocks[node]) * self.rows)
            np.dot(self.states[rows].T, share[-1, rows], by_weight[_FIRST[-1] + node])
        by_block = self._blocks(self.states).transpose(0, 2, 1) @ last
        for number in range(_FEW):
            nodes = np.flatnonzero(few & (self.blocks > number))
            by_weight[_FIRST[-1] + nodes] += by_block[self.begin[nodes] + number]
        return by_state.take(self.place, axis=0), by_weight


def _weighted(p: dict, prior: np.ndarray) -> np.ndarray:
    """Weights of the branches, with the constants of each node as a last row."""
    return np.concatenate([p["O"], (prior + p["o"])[:, None]], axis=1)


def gradients(p: dict, inputs: np.ndarray, target: np.ndarray, code: dict) -> tuple[dict[str, np.ndarray], int]:
    """Of the mean loss over the ids that ``target`` names after the first
    chunk, and their number."""
    wanted = target[1:].ravel()
    real = np.flatnonzero(wanted >= 0)
    if not len(real):
        return {}, 0
    projection = _projection(p)
    states, kept = _attend(p, projection, inputs)
    leaf = code["leaf"].take(wanted[real])
    dg = np.zeros_like(states)
    dg[real], do = _Branches(_weighted(p, code["prior"]), states.take(real, axis=0), leaf).back()
    dx, found = _back(p, projection, inputs, kept, dg)
    found |= {"O": np.ascontiguousarray(do[:, :-1]), "o": np.ascontiguousarray(do[:, -1])}
    order = np.argsort(inputs.ravel().astype(np.uint16), kind="stable")
    by_input = inputs.ravel().take(order)
    cuts = np.flatnonzero(np.append(True, by_input[1:] != by_input[:-1]))
    found["E"] = np.zeros_like(p["E"])
    found["E"][by_input[cuts]] = np.add.reduceat(dx.take(order, axis=0), cuts)
    return found, len(real)


class Trainer:
    """Adagrad over texts that arrive in any number. ``state`` are parameters
    and sums of squares, from :meth:`start` or averaged from others."""

    def __init__(self, state: dict[str, np.ndarray], params: ModelParams):
        self.state = {k: v.copy() for k, v in state.items()}
        self.params, self.tokens = params, 0

    @staticmethod
    def start(params: ModelParams) -> dict[str, np.ndarray]:
        own = initial(params)
        return {**own, **{f"{k}+": np.full_like(v, 1e-8) for k, v in own.items()}}

    def learn(self, inputs: np.ndarray, target: np.ndarray, code: dict) -> None:
        """One pass over the chunks, ``batch`` of them at a step."""
        for low in range(1, len(inputs), self.params.batch):
            now = slice(low - 1, low + self.params.batch)
            found, n = gradients(self.state, inputs[now], target[now], code)
            self.tokens += n
            for name, g in found.items():
                squares = self.state[f"{name}+"]
                squares += g * g
                step = np.sqrt(squares)
                np.divide(g, step, out=step)
                step *= self.params.rate
                self.state[name] -= step


def weights_of(state: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {k: v for k, v in state.items() if not k.endswith("+")}


def score(p: dict, ids: np.ndarray, starts: np.ndarray, code: dict, params: ModelParams, step: int = 1024) -> np.ndarray:
    """Natural log-probability of every text, from the ids of all."""
    inputs, target, first = chunks(ids, starts, code, params.chunk)
    own = np.zeros(len(inputs))
    weights, projection = _weighted(p, code["prior"]), _projection(p)
    # the chunk that stands for what lies before a text names no ids
    for low in range(1, len(inputs), step):
        high = min(low + step, len(inputs))
        wanted = target[low:high].ravel()
        real = np.flatnonzero(wanted >= 0)
        if not len(real):
            continue
        # attention in parts whose arrays a core's cache holds
        states = np.concatenate([
            _attend(p, projection, inputs[at - 1:min(at + _PART, high)])[0] for at in range(low, high, _PART)])
        found = _Branches(weights, states.take(real, axis=0), code["leaf"].take(wanted[real]))
        value = np.zeros(len(wanted))
        value[real] = found.log + code["in_leaf"][wanted[real]]
        own[low:high] = value.reshape(-1, params.chunk).sum(axis=1)
    return np.add.reduceat(own, first[:-1])
