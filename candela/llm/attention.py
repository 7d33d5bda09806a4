"""A small causal self-attention network in numpy: class probabilities of the next token.

One layer: token and place embeddings, one attention head under a causal mask, a rectified
layer over the token and what it attends to, and a softmax over token classes.  Windows overlap, so that every token
but a document's first ones is predicted from a long enough context, and each is scored in
one window only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np

#: Logits are cut here: e to this times the classes is still a float32.
LARGEST = np.float32(70)
#: Logits within this need no shift by their largest before they are raised.
UNSHIFTED = np.float32(30)
#: Windows worked on at a time: enough that calls cost little beside their work, few enough that
#: what they need (some 3 MB) is near the core.
PIECE = 64


def window_starts(lengths: np.ndarray, width: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, start, first scored place) of the windows over sequences of so many predicted tokens.

    The first window of a sequence scores all its places, later ones their last ``stride``.
    """
    counts = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - width) // stride)), 0)
    seq = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return seq, nth * stride, np.where(nth == 0, 0, width - stride)


def flat(m: np.ndarray) -> np.ndarray:
    return m.reshape(-1, m.shape[-1])


class Attention:
    """Parameters in float32; ``classes`` outputs over ``tokens`` inputs."""

    def __init__(self, tokens: int, classes: int, size: int = 16, width: int = 32, seed: int = 11):
        rng = np.random.default_rng(seed)
        f = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.width, self.size, self.shape = width, size, (tokens, classes, size, width)
        self.p = {
            "embed": (rng.standard_normal((tokens, size)) * 0.3).astype(np.float32),
            "place": (rng.standard_normal((width, size)) * 0.1).astype(np.float32),
            "q": f(size, size), "k": f(size, size), "v": f(size, size), "o": f(size, 2 * size),
            "a": f(size, 2 * size), "a0": np.zeros(2 * size, np.float32),
            "c": f(2 * size, classes), "c0": np.zeros(classes, np.float32)}
        self.mask = np.tril(np.ones((width, width), np.float32))
        self.kept: dict[str, np.ndarray] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "kept": {}}

    def room(self, name: str, *shape: int) -> np.ndarray:
        """An array to be written, in memory that the next call with this name takes again."""
        size, dtype = math.prod(shape), self.p["c"].dtype
        if name not in self.kept or self.kept[name].size < size or self.kept[name].dtype != dtype:
            self.kept[name] = np.empty(size, dtype)
        return self.kept[name][:size].reshape(shape)

    def joined(self) -> tuple[np.ndarray, ...]:
        """Parameters side by side, so that one product does for several: q, k and v; a; o and its bias; c and its
        bias.  The last hidden state is the one that meets c's bias: nothing of a, 1 by o's bias."""
        p, n = self.p, 2 * self.size
        a, o = np.zeros((self.size, n + 1), p["a"].dtype), np.zeros((self.size + 1, n + 1), p["o"].dtype)
        a[:, :n], o[:-1, :n], o[-1, :n], o[-1, n] = p["a"], p["o"], p["a0"], 1
        return (np.concatenate([p["q"] * np.float32(self.size ** -0.5), p["k"], p["v"]], 1), a, o,
                np.concatenate([p["c"], p["c0"][None]]))

    def hidden(self, ids: np.ndarray, keep: dict | None = None, joined: tuple[np.ndarray, ...] | None = None) -> np.ndarray:
        """Hidden states of windows of ids (n, width); ``keep`` takes what comes after needs: ``z`` are all places'
        states and a last one that is always 1."""
        (qkv, a, o, _), n, width, size = joined or self.joined(), *ids.shape, self.size
        x = self.p["embed"].take(ids, 0)
        x += self.p["place"]
        # Products over all places at once: one per window would be too small to be fast.
        # A column of ones behind v sums the weights of a place, and meets the bias behind what is mixed.
        parts = self.room("parts", n, width, 3 * size + 1)
        np.matmul(flat(x), qkv, out=flat(parts)[:, :-1])
        parts[:, :, -1] = 1
        w = np.matmul(parts[:, :, :size], parts[:, :, size:2 * size].transpose(0, 2, 1), out=self.room("w", n, width, width))
        if w.size and not w.max() < LARGEST:
            np.minimum(w, LARGEST, out=w)
        np.exp(w, out=w)
        w *= self.mask
        mixed = np.matmul(w, parts[:, :, 2 * size:], out=self.room("mixed", n, width, size + 1))
        total = mixed[:, :, -1:].copy()
        mixed /= total
        z = flat(mixed) @ o
        z += np.matmul(flat(x), a, out=self.room("z", n * width, 2 * size + 1))
        active = z > 0
        z *= active
        if keep is not None:
            keep.update(x=x, parts=parts, w=w, total=total, mixed=mixed, active=active, z=z)
        return z.reshape(n, width, -1)[:, :, :-1]

    def log_probabilities(self, ids: np.ndarray, rows: np.ndarray, places: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural logarithm of P(class) for each (row, place) of the windows and its target class."""
        joined, t = self.joined(), {}
        self.hidden(ids, t, joined)
        y = np.matmul(t["z"].take(rows * self.width + places, 0), joined[-1], out=self.room("y", len(rows), self.shape[1]))
        if y.size and not y.max() < LARGEST:
            np.minimum(y, LARGEST, out=y)  # the sum stays finite without looking for each row's largest
        own = y.reshape(-1)[np.arange(0, y.size, y.shape[1]) + targets]
        np.exp(y, out=y)
        return own - np.log(y @ np.ones(y.shape[1], y.dtype))

    def gradients(self, ids: np.ndarray, targets: np.ndarray, valid: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss of the valid places, and its gradient by parameter; summed over pieces of the windows."""
        size, joined = self.size, self.joined()
        loss, sums, every = 0.0, [np.zeros_like(m) for m in (*joined, self.p["place"])], self.room("dx", *ids.shape, size)
        share = valid / max(1, int(valid.sum()))
        for some in batches(ids, PIECE):
            lost, own = self._gradients(ids[some], targets[some], share[some], joined, every[some])
            loss += lost
            for total, d in zip(sums, own):
                total += d
        dqkv, da, do, dc, place = sums
        g = {"embed": np.zeros_like(self.p["embed"]), "place": place, "q": dqkv[:, :size] * np.float32(size ** -0.5),
             "k": dqkv[:, size:2 * size], "v": dqkv[:, 2 * size:], "a": da[:, :-1], "o": do[:-1, :-1], "a0": do[-1, :-1],
             "c": dc[:-1], "c0": dc[-1]}
        if ids.size:  # places of the same id side by side: a sum each
            order = np.argsort(ids.reshape(-1).astype(np.min_scalar_type(self.shape[0])), kind="stable")
            own = ids.reshape(-1)[order]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            g["embed"][own[first]] = np.add.reduceat(flat(every).take(order, 0), first)
        return loss, g

    def _gradients(self, ids: np.ndarray, targets: np.ndarray, share: np.ndarray, joined: tuple[np.ndarray, ...],
                   dx: np.ndarray) -> tuple[float, tuple[np.ndarray, ...]]:
        """Loss of the places by their share, its gradient by joined parameter and by place; ``dx`` takes that by
        the embedding at each place."""
        (qkv, a, o, c), t, n, width, size = joined, {}, *ids.shape, self.size
        self.hidden(ids, t, joined)
        z = t["z"]
        y = np.matmul(z, c, out=self.room("y", len(z), self.shape[1]))
        if not -UNSHIFTED < y.min() <= y.max() < UNSHIFTED:
            y -= y.max(1, keepdims=True)
        share = share.reshape(-1)
        at = np.arange(0, y.size, y.shape[1]) + targets.reshape(-1)
        own = y.reshape(-1)[at]
        dy = np.exp(y, out=y)
        total = dy @ np.ones((dy.shape[1], 1), dy.dtype)
        loss = float(((np.log(total[:, 0]) - own) * share).sum())
        share = share.astype(np.float32)
        dy *= share[:, None] / total
        dy.reshape(-1)[at] -= share
        dh = np.matmul(dy, c.T, out=self.room("z", *z.shape))
        dh *= t["active"]
        x, parts, w, mixed = t["x"], t["parts"], t["w"], t["mixed"]
        dm = np.matmul(dh, o.T, out=self.room("dm", n * width, size + 1)).reshape(mixed.shape)
        dm /= t["total"]
        # The shares of a place sum to one, so their mean gradient is that of what they mix:
        # it stands against the column of ones behind v.
        np.negative(np.einsum("nij,nij->ni", dm[:, :, :-1], mixed[:, :, :-1]), out=dm[:, :, -1])
        ds = np.matmul(dm, parts[:, :, 2 * size:].transpose(0, 2, 1), out=self.room("ds", *w.shape))
        ds *= w
        dparts = self.room("dparts", n, width, 3 * size)
        np.matmul(ds, parts[:, :, size:2 * size], out=dparts[:, :, :size])
        np.matmul(ds.transpose(0, 2, 1), parts[:, :, :size], out=dparts[:, :, size:2 * size])
        np.matmul(w.transpose(0, 2, 1), dm[:, :, :size], out=dparts[:, :, 2 * size:])
        np.matmul(dh, a.T, out=flat(dx))
        dx += (flat(dparts) @ qkv.T).reshape(dx.shape)
        return loss, (flat(x).T @ flat(dparts), (dh.T @ flat(x)).T, (dh.T @ flat(mixed)).T, (dy.T @ z).T, dx.sum(0))

    def fit(self, ids: np.ndarray, targets: np.ndarray, valid: np.ndarray, epochs: int, batch: int = 64,
            rate: float = 0.006, seed: int = 5) -> list[float]:
        """Adam over shuffled windows with a falling rate; returns the mean loss of each epoch."""
        rng, losses, step, adam = np.random.default_rng(seed), [], 0, Adam(self)
        steps = epochs * -(-len(ids) // batch)
        for _ in range(epochs):
            order, seen = rng.permutation(len(ids)), []
            for i in range(0, len(order), batch):
                own = order[i:i + batch]
                step += 1
                seen.append(adam.step(ids[own], targets[own], valid[own], rate * min(1.0, step / 50) * (1 - 0.95 * step / steps)))
            losses.append(float(np.mean(seen)) if seen else 0.0)
        return losses


class Adam:
    """Steps of a network along the gradients of windows, with moments that fade."""

    def __init__(self, net: Attention):
        self.net, self.steps = net, 0
        self.m, self.s = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))
        self.kept = {k: (np.empty_like(v), np.empty_like(v)) for k, v in net.p.items()}  # to work in

    def step(self, ids: np.ndarray, targets: np.ndarray, valid: np.ndarray, rate: float) -> float:
        """One step; returns the mean loss before it."""
        loss, g = self.net.gradients(ids, targets, valid)
        self.steps += 1
        for k, d in g.items():
            m, s, (a, b) = self.m[k], self.s[k], self.kept[k]
            np.subtract(d, m, out=a)
            a *= np.float32(0.1)
            m += a  # m += 0.1 * (d - m)
            np.multiply(d, d, out=a)
            a -= s
            a *= np.float32(0.01)
            s += a  # s += 0.01 * (d * d - s)
            np.divide(s, np.float32(1 - 0.99 ** self.steps), out=a)
            np.sqrt(a, out=a)
            a += np.float32(1e-6)
            np.divide(m, np.float32(1 - 0.9 ** self.steps), out=b)
            b *= np.float32(rate)
            b /= a
            self.net.p[k] -= b
        return loss


def batches(starts: np.ndarray, most: int = PIECE) -> Iterator[slice]:
    return (slice(i, i + most) for i in range(0, len(starts), most))
