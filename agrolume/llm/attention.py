"""A small causal self-attention language model in numpy.

The frequent tokens have places of their own in clusters of tokens that follow like
tokens; the others share one place per cluster and their part of its corpus counts. The
probability of a token is that of its cluster, times that of its place in the cluster, both
from the state that one head of masked attention reads from the tokens before it in
the window. Embeddings begin as singular vectors of the neighbour counts, and
training goes on from there by gradients.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WINDOW, FRESH = 16, 12
#: Stands for no token.
NONE = 65_535
WIDTH = 16
#: Clusters and places in each; the last place of a cluster is shared by rare tokens.
CLUSTERS, PLACES = 32, 32
OWN = CLUSTERS * (PLACES - 1)
#: Windows in a step of training, and of scoring.
BATCH, SCORED = 256, 512
#: Input class 0 begins a text; frequent tokens follow, then the shared places.
INPUTS = 1 + OWN + CLUSTERS


def ranks(counts: np.ndarray) -> np.ndarray:
    """Class of every token id: its rank if it is among the OWN most frequent, else OWN + its band of like mass."""
    order = np.argsort(-counts, kind="stable")
    out = np.empty(len(counts), np.int64)
    out[order[:OWN]] = np.arange(OWN)
    mass = np.cumsum(counts[order[OWN:]] + 0.1)
    out[order[OWN:]] = OWN + np.minimum((mass / mass[-1] * CLUSTERS).astype(np.int64), CLUSTERS - 1)
    return out


@dataclass(frozen=True)
class Classes:
    """Per token id: input class, cluster, place in it, and log10 of its share of that place."""

    inputs: np.ndarray
    cluster: np.ndarray
    place: np.ndarray
    share: np.ndarray

    @staticmethod
    def of(counts: np.ndarray, follows: np.ndarray) -> tuple[Classes, np.ndarray]:
        """Classes, and parameters to begin with, from token counts and from how often class j follows class i."""
        rank = ranks(counts)
        smooth = follows + follows.sum(1, keepdims=True) * follows.sum(0) / max(1.0, follows.sum()) + 1e-3
        lift = np.log(smooth * smooth.sum() / (smooth.sum(1, keepdims=True) * smooth.sum(0)))
        # Frequent tokens matter more; their signs fix the vectors.
        left, size, right = np.linalg.svd(lift * np.sqrt(smooth.sum(0) / smooth.sum()) ** 0.5)
        # Halve by the median of one vector after another: tokens of a cluster follow like tokens.
        groups = [np.arange(OWN)]
        for v in range(CLUSTERS.bit_length() - 1):
            groups = [half for g in groups for half in np.array_split(g[np.argsort(right[v, g], kind="stable")], 2)]
        cluster, place = np.empty(OWN + CLUSTERS, np.int64), np.full(OWN + CLUSTERS, PLACES - 1)
        spare: list[int] = []
        for c, g in enumerate(groups):
            cluster[g[: PLACES - 1]], place[g[: PLACES - 1]] = c, np.arange(len(g[: PLACES - 1]))
            spare += g[PLACES - 1 :].tolist()
        for c, g in enumerate(groups):  # halves may differ by a token
            for p in range(len(g), PLACES - 1):
                cluster[k := spare.pop()], place[k] = c, p
        cluster[OWN:] = np.arange(CLUSTERS)
        total = np.bincount(rank, counts + 0.1, OWN + CLUSTERS)
        start = initial(left[:, :WIDTH] * size[:WIDTH], right[:WIDTH], follows.sum(0), cluster, place)
        return Classes(1 + rank, cluster[rank], place[rank], np.log10((counts + 0.1) / total[rank])), start


SHAPES = {
    "embed": (INPUTS, WIDTH), "spot": (WINDOW, WIDTH), "qkv": (WIDTH, 3 * WIDTH), "mix": (WIDTH, WIDTH),
    "cluster": (WIDTH, CLUSTERS), "cluster_bias": (CLUSTERS,), "token": (CLUSTERS, WIDTH, PLACES), "token_bias": (CLUSTERS, PLACES),
}


def initial(left: np.ndarray, right: np.ndarray, mass: np.ndarray, cluster: np.ndarray, place: np.ndarray, seed: int = 3) -> np.ndarray:
    draw = np.random.default_rng(seed)
    p = {n: draw.normal(0, 0.1, s) for n, s in SHAPES.items()}
    p["embed"][1:] = left
    p["token"][cluster, :, place] = right.T
    p["token_bias"][cluster, place] = np.log(mass + 1.0)
    weight = np.bincount(cluster, mass + 1.0, CLUSTERS)
    p["token_bias"] -= np.log(weight)[:, None]
    p["cluster_bias"] = np.log(weight / weight.sum())
    p["cluster"] = np.stack([np.bincount(cluster, right[j] * (mass + 1.0), CLUSTERS) / weight for j in range(WIDTH)])
    return np.concatenate([p[n].ravel() for n in SHAPES]).astype(np.float32)


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


_HIDDEN = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)


def forward(p: dict[str, np.ndarray], inputs: np.ndarray):
    """States (B, W, WIDTH) of windows of input classes, and what the gradient needs."""
    x = p["embed"][inputs]
    x += p["spot"]
    # Flat rows are one product instead of one per window.
    q, k, v = np.split((x.reshape(-1, WIDTH) @ p["qkv"]).reshape(*inputs.shape, 3 * WIDTH), 3, axis=2)
    weights = q @ k.transpose(0, 2, 1)
    weights *= np.float32(WIDTH**-0.5)
    weights += _HIDDEN
    np.exp(weights, out=weights)
    weights /= (weights.reshape(-1, WINDOW) @ np.ones((WINDOW, 1), weights.dtype)).reshape(*inputs.shape, 1)
    read = weights @ v
    return x + (read.reshape(-1, WIDTH) @ p["mix"]).reshape(x.shape), (x, q, k, v, weights, read)


def _shares(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural log of the share of one row per column; ``logits`` become all shares. Columns lie beside each other, so all steps run along memory."""
    logits -= logits.max(0)
    out = logits[at, np.arange(len(at))]
    np.exp(logits, out=logits)
    total = logits.sum(0)
    logits /= total
    return out - np.log(total)


def by_cluster(cluster: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of rows by cluster, and where each cluster that occurs begins and ends in it."""
    order = np.argsort(cluster, kind="stable")
    edges = np.searchsorted(cluster[order], np.arange(CLUSTERS + 1)).tolist()
    return order, [(c, edges[c], edges[c + 1]) for c in range(CLUSTERS) if edges[c] < edges[c + 1]]


def log_probability(p: dict[str, np.ndarray], state: np.ndarray, cluster: np.ndarray, place: np.ndarray, grads: dict[str, np.ndarray] | None = None):
    """Natural log of P(cluster) * P(place in it) per row; with ``grads`` also fills them in and returns the state's gradient of minus the sum."""
    rows = np.arange(len(state))
    order, runs = by_cluster(cluster)
    outer = p["cluster"].T @ state.T + p["cluster_bias"][:, None]
    columns = np.ascontiguousarray(state[order].T)
    inner = np.empty((PLACES, len(state)), state.dtype)
    for c, a, b in runs:
        inner[:, a:b] = p["token"][c].T @ columns[:, a:b] + p["token_bias"][c][:, None]
    out = _shares(outer, cluster)
    out[order] += _shares(inner, place[order])
    if grads is None:
        return out
    outer[cluster, rows] -= 1
    inner[place[order], rows] -= 1
    grads["cluster"], grads["cluster_bias"] = state.T @ outer.T, outer.sum(1)
    grads["token"], grads["token_bias"] = np.zeros_like(p["token"]), np.zeros_like(p["token_bias"])
    below = np.empty_like(columns)
    for c, a, b in runs:
        grads["token"][c], grads["token_bias"][c] = columns[:, a:b] @ inner[:, a:b].T, inner[:, a:b].sum(1)
        below[:, a:b] = p["token"][c] @ inner[:, a:b]
    ds = outer.T @ p["cluster"].T
    ds[order] += below.T
    return out, ds


def _picked(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural log of the share of one row per column."""
    top = logits.max(0)
    out = logits[at, np.arange(len(at))] - top
    logits -= top
    np.exp(logits, out=logits)
    return out - np.log(logits.sum(0))


def score_only(p: dict[str, np.ndarray], state: np.ndarray, cluster: np.ndarray, place: np.ndarray) -> np.ndarray:
    """What log_probability gives without gradients."""
    order, runs = by_cluster(cluster)
    columns = np.ascontiguousarray(state[order].T)
    inner = np.empty((PLACES, len(state)), state.dtype)
    for c, a, b in runs:
        np.add(p["token"][c].T @ columns[:, a:b], p["token_bias"][c][:, None], out=inner[:, a:b])
    out = np.empty(len(state), np.float64)
    out[order] = _picked(p["cluster"].T @ columns + p["cluster_bias"][:, None], cluster[order]) + _picked(inner, place[order])
    return out


def gradient(flat: np.ndarray, inputs: np.ndarray, cluster: np.ndarray, place: np.ndarray, known: np.ndarray) -> tuple[float, np.ndarray]:
    """(mean loss, its gradient) over the known spots of a batch."""
    p, g = unpacked(flat), {}
    state, (x, q, k, v, weights, read) = forward(p, inputs)
    n = np.float32(max(1, int(known.sum())))
    logp, inner = log_probability(p, state[known], cluster[known], place[known], g)
    ds = np.zeros_like(state)
    ds[known] = inner
    flat_ds, flat_x = ds.reshape(-1, WIDTH), x.reshape(-1, WIDTH)
    g["mix"] = read.reshape(-1, WIDTH).T @ flat_ds
    dread = (flat_ds @ p["mix"].T).reshape(ds.shape)
    dv = weights.transpose(0, 2, 1) @ dread
    dw = dread @ v.transpose(0, 2, 1)
    dscore = weights * (dw - np.einsum("bij,bij->bi", dw, weights)[:, :, None]) * np.float32(WIDTH**-0.5)
    dqkv = np.concatenate((dscore @ k, dscore.transpose(0, 2, 1) @ q, dv), 2).reshape(-1, 3 * WIDTH)
    g["qkv"] = flat_x.T @ dqkv
    dx = flat_ds + dqkv @ p["qkv"].T
    g["spot"] = dx.reshape(x.shape).sum(0)
    at = inputs.ravel()
    g["embed"] = np.stack([np.bincount(at, column, INPUTS) for column in np.ascontiguousarray(dx.T)], 1)
    return float(-logp.sum() / n), (np.concatenate([g[name].ravel() for name in SHAPES]) / n).astype(np.float32)


class Learner:
    """Adam over blocks of raw windows that arrive one after another; the rate falls to a tenth over about ``steps`` steps."""

    def __init__(self, flat: np.ndarray, classes: Classes, rate: float, steps: int):
        self.flat, self.classes, self.rate, self.steps, self.done = flat.copy(), classes, rate, max(1, steps), 0
        self.m, self.v = np.zeros_like(flat), np.zeros_like(flat)

    def learn(self, raw: np.ndarray) -> None:
        for a in range(0, len(raw), BATCH):
            _, g = gradient(self.flat, *expanded(raw[a : a + BATCH], self.classes))
            self.m += 0.1 * (g - self.m)
            self.v += 0.01 * (g * g - self.v)
            self.done += 1
            rate = self.rate * max(0.1, 1 - (self.done - 1) / self.steps)
            step = rate * (self.m / (1 - 0.9**self.done)) / (np.sqrt(self.v / (1 - 0.99**self.done)) + 1e-8)
            self.flat -= step.astype(np.float32)


def training_windows(ids: np.ndarray) -> np.ndarray:
    """Windows of a text that do not overlap, laid out like those of raw_windows: each token is learned from once."""
    n = len(ids)
    at = np.arange(-(-n // WINDOW))[:, None] * WINDOW + np.arange(-1, WINDOW)
    inside = (at >= 0) & (at < n)
    out = np.empty((len(at), WINDOW + 2), np.uint16)
    out[:, :-1] = np.where(inside, ids[np.clip(at, 0, n - 1)], NONE)
    out[:, -1] = inside[:, 1:] @ (1 << np.arange(WINDOW))
    return out


def raw_windows(ids: np.ndarray) -> np.ndarray:
    """Windows of a text, WINDOW + 2 numbers each: the token before it, its tokens (NONE where there is none), and a bit per spot that is scored here.

    The first window scores all its spots, later ones the last FRESH: each token is scored once, with
    WINDOW - FRESH tokens before it at least. Spots beyond the end are not scored.
    """
    n = len(ids)
    at = np.arange(1 + max(0, -(-(n - WINDOW) // FRESH)))[:, None] * FRESH + np.arange(-1, WINDOW)
    inside = (at >= 0) & (at < n)
    known = inside[:, 1:].copy()
    known[1:, : WINDOW - FRESH] = False
    out = np.empty((len(at), WINDOW + 2), np.uint16)
    out[:, :-1] = np.where(inside, ids[np.clip(at, 0, n - 1)], NONE)
    out[:, -1] = known @ (1 << np.arange(WINDOW))
    return out


def expanded(raw: np.ndarray, classes: Classes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(input classes, clusters, places, which spots are scored) of raw windows."""
    known = (raw[:, -1:].astype(np.int64) >> np.arange(WINDOW) & 1).astype(bool)
    ids = np.where(raw[:, :-1] == NONE, 0, raw[:, :-1])
    inputs = np.where(raw[:, :-2] == NONE, 0, classes.inputs[ids[:, :-1]])
    return inputs, classes.cluster[ids[:, 1:]], classes.place[ids[:, 1:]], known


def log10_probability(flat: np.ndarray, classes: Classes, texts: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each text (ids, at least one), windows of all texts in batches."""
    p = unpacked(flat)
    parts = [raw_windows(ids) for ids in texts]
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in parts])
    raw = np.concatenate(parts)
    out = np.array([classes.share[ids].sum() for ids in texts])
    for a in range(0, len(raw), SCORED):
        inputs, cluster, place, here = expanded(raw[a : a + SCORED], classes)
        state, _ = forward(p, inputs)
        logp = score_only(p, state[here], cluster[here], place[here])
        out += np.bincount(owner[a : a + SCORED].repeat(here.sum(1)), logp, len(texts)) / np.log(10)
    return out
