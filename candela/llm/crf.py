"""A linear-chain conditional random field with two tags, in numpy."""

from __future__ import annotations

import numpy as np

#: Steps between tokens with features beyond which the chain has forgotten its past.
FORGOTTEN = 256


class Chain:
    """Weights of the chain: ``emit`` per feature, ``bias`` of tag 1, ``trans`` between tags."""

    def __init__(self, features: int):
        self.emit = np.zeros(features)
        self.bias = -4.0
        self.trans = np.zeros((2, 2))

    def prepare(self) -> "Chain":
        step = np.exp(self.trans)
        quiet = step * np.array([1.0, np.exp(self.bias)])
        powers = [np.eye(2)]
        for _ in range(FORGOTTEN):
            p = powers[-1] @ quiet
            powers.append(p / p.sum())
        self._step, self._powers = step, powers
        return self

    def marginals(self, at: list[int], scores: list[float], n: int) -> np.ndarray:
        """P(tag 1) at the tokens ``at`` (ascending, of ``n``), whose summed weights are ``scores``.

        Tokens between them carry no feature, so the forward and backward vectors
        cross them by powers of one matrix.
        """
        step, powers = self._step, self._powers
        psi = np.stack([np.ones(len(at)), np.exp(np.minimum(self.bias + np.asarray(scores), 50.0))], 1)
        alpha = np.empty((len(at), 2))
        beta = np.empty((len(at), 2))
        v = np.ones(2)
        if at[0]:
            v = np.array([1.0, np.exp(self.bias)]) @ powers[min(at[0] - 1, FORGOTTEN)] @ step
        for i in range(len(at)):
            if i:
                v = alpha[i - 1] @ powers[min(at[i] - at[i - 1] - 1, FORGOTTEN)] @ step
            v = v * psi[i]
            alpha[i] = v / v.sum()
        v = powers[min(n - 1 - at[-1], FORGOTTEN)] @ np.ones(2)
        for i in reversed(range(len(at))):
            if i < len(at) - 1:
                v = powers[min(at[i + 1] - at[i] - 1, FORGOTTEN)] @ step @ (psi[i + 1] * beta[i + 1])
            beta[i] = v / v.sum()
        both = alpha * beta
        return both[:, 1] / both.sum(1)

    def fit(self, combos: np.ndarray, of_combo: list[tuple[int, ...]], tags: np.ndarray,
            lengths: np.ndarray, weights: np.ndarray, rounds: int = 150, ridge: float = 1e-2, rate: float = 0.15) -> "Chain":
        """Maximum likelihood by Adam.

        ``combos`` (sequences x tokens) holds for each token its place in ``of_combo`` (the
        features that a token has); ``tags`` are 0/1; ``weights`` count equal sequences.
        """
        combo = np.array([i for i, has in enumerate(of_combo) for _ in has], int)
        feature = np.array([f for has in of_combo for f in has], int)
        n, width = combos.shape
        inside = np.arange(width)[None, :] < lengths[:, None]
        w = weights[:, None] * inside
        seen = np.bincount(combos[inside], (w * tags)[inside], len(of_combo))
        pairs_in = inside[:, 1:] * weights[:, None]
        seen_pairs = np.zeros((2, 2))
        np.add.at(seen_pairs, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), pairs_in.ravel())
        total = float(w.sum())
        x = np.concatenate([self.emit, [self.bias], self.trans.ravel()])
        m, s = np.zeros_like(x), np.zeros_like(x)
        for turn in range(1, rounds + 1):
            emit, bias, trans = x[:-5], x[-5], x[-4:].reshape(2, 2)
            summed = np.bincount(combo, emit[feature], len(of_combo))
            psi = np.exp(np.clip(summed + bias, -30, 30))[combos]
            step = np.exp(trans)
            alpha = np.empty((n, width, 2))
            alpha[:, 0, 0], alpha[:, 0, 1] = 1.0, psi[:, 0]
            alpha[:, 0] /= alpha[:, 0].sum(1, keepdims=True)
            for t in range(1, width):
                v = alpha[:, t - 1] @ step
                v[:, 1] *= psi[:, t]
                alpha[:, t] = v / v.sum(1, keepdims=True)
            beta = np.ones((n, width, 2))
            for t in range(width - 2, -1, -1):
                v = beta[:, t + 1].copy()
                v[:, 1] *= psi[:, t + 1]
                v = v @ step.T
                v /= v.sum(1, keepdims=True)
                beta[:, t] = np.where(inside[:, t + 1, None], v, 1.0)
            both = alpha * beta
            ones = both[:, :, 1] / both.sum(2)
            expected = np.bincount(combos[inside], (w * ones)[inside], len(of_combo))
            right = beta[:, 1:].copy()
            right[:, :, 1] *= psi[:, 1:]
            joint = alpha[:, :-1, :, None] * step * right[:, :, None, :]
            joint /= joint.sum((2, 3), keepdims=True)
            expected_pairs = (joint * pairs_in[:, :, None, None]).sum((0, 1))
            gap = expected - seen
            grad = np.concatenate([np.bincount(feature, gap[combo], len(emit)), [gap.sum()], (expected_pairs - seen_pairs).ravel()])
            grad = grad / max(total, 1.0) * 100 + ridge * x / 100
            m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad * grad
            x = x - rate * (m / (1 - 0.9 ** turn)) / (np.sqrt(s / (1 - 0.99 ** turn)) + 1e-8)
        self.emit, self.bias, self.trans = x[:-5], float(x[-5]), x[-4:].reshape(2, 2)
        return self
