"""Two small character networks in plain numpy, with their gradients.

Both read windows of byte classes (``ALPHABET`` symbols) and are trained with Adam from a fixed
seed, so equal training rows give equal models. They are small enough to travel in a closure.
"""

from __future__ import annotations

import numpy as np

#: Symbols: 0 padding, 1-95 printable ASCII, 96 line feed, 97 other white space, 98 any other byte.
ALPHABET = 99
SYMBOL = np.full(256, 98, np.int16)
SYMBOL[0x20:0x7F] = np.arange(1, 96)
SYMBOL[0x0A] = 96
SYMBOL[[0x09, 0x0B, 0x0C, 0x0D]] = 97


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale = min(1.0, 5.0 / (norm + 1e-12))
        for k, g in grads.items():
            g = g * scale
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            self.params[k] -= self.rate * (self.m[k] / (1 - 0.9 ** self.t)) / (
                np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def recall_threshold(found: np.ndarray, recall: float, otherwise: float) -> float:
    """The largest threshold that ``recall`` of the findings' probabilities reach; ``otherwise`` without findings."""
    found = np.sort(found)
    return float(found[int((1 - recall) * len(found) + 1e-9)]) - 1e-9 if len(found) else otherwise


class CharCnn:
    """Embedding, one convolution, rectifier, maximum over time, a logit.

    A window has two planes: its symbols, and a mark on those of the candidate itself.
    """

    def __init__(self, seed: int = 0, embed: int = 12, width: int = 5, filters: int = 24):
        rng = np.random.default_rng(seed)
        self.width = width
        self.p = {"e": rng.normal(0, 0.3, (ALPHABET, embed)),
                  "m": rng.normal(0, 0.3, embed),
                  "w": rng.normal(0, (2 / (width * embed)) ** 0.5, (width * embed, filters)),
                  "b": np.zeros(filters), "o": rng.normal(0, 0.3, filters), "c": np.zeros(1)}
        self.scale, self.shift, self.threshold = 1.0, 0.0, 0.5

    def _columns(self, x: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        emb = self.p["e"][x] + mark[..., None] * self.p["m"]
        n, t, d = emb.shape
        view = np.lib.stride_tricks.sliding_window_view(emb, self.width, axis=1)  # n, t', d, width
        return emb, view.transpose(0, 1, 3, 2).reshape(n, t - self.width + 1, self.width * d)

    def logits(self, x: np.ndarray, mark: np.ndarray) -> np.ndarray:
        _, cols = self._columns(x, mark)
        return np.maximum(cols @ self.p["w"] + self.p["b"], 0).max(axis=1) @ self.p["o"] + self.p["c"][0]

    def loss_and_grads(self, x: np.ndarray, mark: np.ndarray, y: np.ndarray):
        emb, cols = self._columns(x, mark)
        n, t, _ = cols.shape
        pre = cols @ self.p["w"] + self.p["b"]
        act = np.maximum(pre, 0)
        top = act.argmax(axis=1)
        best = np.take_along_axis(act, top[:, None, :], 1)[:, 0]
        z = best @ self.p["o"] + self.p["c"][0]
        prob = sigmoid(z)
        loss = -np.mean(y * np.log(prob + 1e-12) + (1 - y) * np.log(1 - prob + 1e-12))
        dz = (prob - y) / n
        g = {"o": best.T @ dz, "c": np.array([dz.sum()])}
        dbest = dz[:, None] * self.p["o"] * (best > 0)
        dpre = np.zeros_like(pre)
        np.put_along_axis(dpre, top[:, None, :], dbest[:, None, :], 1)
        g["w"] = np.einsum("ntk,ntf->kf", cols, dpre)
        g["b"] = dpre.sum(axis=(0, 1))
        dcols = (dpre @ self.p["w"].T).reshape(n, t, self.width, -1)
        demb = np.zeros_like(emb)
        for k in range(self.width):
            demb[:, k:k + t] += dcols[:, :, k]
        g["e"] = np.zeros_like(self.p["e"])
        np.add.at(g["e"], x, demb)
        g["m"] = (demb * mark[..., None]).sum(axis=(0, 1))
        return loss, g

    def probability(self, x: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Calibrated (Platt) probability that the candidate is a finding."""
        return sigmoid(self.scale * self.logits(x, mark) + self.shift)

    def fit(self, x, mark, y, epochs: int = 12, batch: int = 64, rate: float = 0.01, recall: float = 0.95,
            seed: int = 1, group: np.ndarray | None = None) -> CharCnn:
        """Train on four fifths; calibrate and choose the threshold on the rest.

        The threshold is the largest that keeps ``recall`` of the held-out findings, however low that is.
        Rows of one ``group`` are windows of one finding: they are held out together, and the greatest
        probability counts, as in scans.
        """
        rng = np.random.default_rng(seed)
        group = np.arange(len(y)) if group is None else np.unique(group, return_inverse=True)[1]
        order = rng.permutation(int(group.max()) + 1)
        out = np.isin(group, order[::5])
        held, used = np.flatnonzero(out), np.flatnonzero(~out)
        adam = Adam(self.p, rate)
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(used), max(1, len(used) // batch)):
                adam.step(self.loss_and_grads(x[part], mark[part], y[part])[1])
        z, target = self.logits(x[held], mark[held]), y[held]
        for _ in range(200):  # two parameters, plain descent
            q = sigmoid(self.scale * z + self.shift)
            self.scale -= 0.1 * float(((q - target) * z).mean())
            self.shift -= 0.1 * float((q - target).mean())
        best = np.zeros(len(order))
        np.maximum.at(best, group[held], self.probability(x[held], mark[held]))
        self.threshold = recall_threshold(best[np.unique(group[held][target > 0.5])], recall, self.threshold)
        return self


def gate(x: np.ndarray) -> np.ndarray:
    """A gate of the LSTM: the sigmoid's tangent at 0, cut at 0 and 1, which needs no exponential."""
    return np.clip(0.25 * x + 0.5, 0, 1)


class BiLstmCrf:
    """Embedding, one LSTM each way with piecewise linear gates, and a linear-chain CRF over the tags."""

    def __init__(self, tags: int, seed: int = 0, embed: int = 12, hidden: int = 20):
        rng = np.random.default_rng(seed)
        h = hidden
        self.h, self.tags = h, tags
        self.p = {"e": rng.normal(0, 0.3, (ALPHABET, embed)), "o": rng.normal(0, 0.2, (2 * h, tags)),
                  "ob": np.zeros(tags), "t": rng.normal(0, 0.05, (tags, tags)), "s": np.zeros(tags)}
        for d in "fb":
            self.p[d + "x"] = rng.normal(0, embed ** -0.5, (embed, 4 * h))
            self.p[d + "h"] = rng.normal(0, h ** -0.5, (h, 4 * h))
            self.p[d + "c"] = np.concatenate((np.zeros(h), np.ones(h), np.zeros(2 * h)))  # i f g o

    def _lstm(self, x: np.ndarray, d: str, keep: bool):
        """States of one direction for symbols (n, t); the backward one reads from the end."""
        n, t = x.shape
        h = self.h
        table = self.p["e"] @ self.p[d + "x"] + self.p[d + "c"]
        hs = np.zeros((t, n, h))
        now, cell = np.zeros((n, h)), np.zeros((n, h))
        tape = []
        for k in (range(t) if d == "f" else range(t - 1, -1, -1)):
            a = table[x[:, k]] + now @ self.p[d + "h"]
            i, f, o = gate(a[:, :h]), gate(a[:, h:2 * h]), gate(a[:, 3 * h:])
            g = np.clip(a[:, 2 * h:3 * h], -1, 1)
            new = f * cell + i * g
            tc = np.clip(new, -1, 1)
            if keep:
                tape.append((k, now, cell, i, f, g, o, tc))
            now, cell = o * tc, new
            hs[k] = now
        return hs, tape

    def emissions(self, x: np.ndarray, keep: bool = False):
        f, tf = self._lstm(x, "f", keep)
        b, tb = self._lstm(x, "b", keep)
        hs = np.concatenate((f, b), axis=2)
        return hs @ self.p["o"] + self.p["ob"], hs, tf, tb

    def _forward(self, em: np.ndarray) -> np.ndarray:
        alpha = np.empty_like(em)
        alpha[0] = em[0] + self.p["s"]
        for k in range(1, len(em)):
            s = alpha[k - 1][:, :, None] + self.p["t"]
            m = s.max(axis=1)
            alpha[k] = m + np.log(np.exp(s - m[:, None]).sum(axis=1)) + em[k]
        return alpha

    def _backward(self, em: np.ndarray) -> np.ndarray:
        beta = np.zeros_like(em)
        for k in range(len(em) - 2, -1, -1):
            s = self.p["t"] + (em[k + 1] + beta[k + 1])[:, None, :]
            m = s.max(axis=2)
            beta[k] = m + np.log(np.exp(s - m[:, :, None]).sum(axis=2))
        return beta

    @staticmethod
    def _total(last: np.ndarray) -> np.ndarray:
        m = last.max(axis=1)
        return m + np.log(np.exp(last - m[:, None]).sum(axis=1))

    def loss_and_grads(self, x: np.ndarray, y: np.ndarray):
        """Mean negative log-likelihood of the tag sequences ``y`` (n, t)."""
        n, t = x.shape
        em, hs, tf, tb = self.emissions(x, keep=True)
        alpha, beta = self._forward(em), self._backward(em)
        z = self._total(alpha[-1])
        rows = np.arange(n)
        gold = self.p["s"][y[:, 0]] + em[0][rows, y[:, 0]]
        for k in range(1, t):
            gold = gold + self.p["t"][y[:, k - 1], y[:, k]] + em[k][rows, y[:, k]]
        loss = float((z - gold).mean())
        dem = np.exp(alpha + beta - z[None, :, None])
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        for k in range(1, t):
            pair = np.exp(alpha[k - 1][:, :, None] + self.p["t"] + (em[k] + beta[k])[:, None, :] - z[:, None, None])
            g["t"] += pair.sum(axis=0)
            np.add.at(g["t"], (y[:, k - 1], y[:, k]), -1.0)
        for k in range(t):
            dem[k][rows, y[:, k]] -= 1.0
        g["t"] /= n
        dem /= n
        g["s"] = dem[0].sum(axis=0)
        g["o"] = np.einsum("tnh,tnk->hk", hs, dem)
        g["ob"] = dem.sum(axis=(0, 1))
        dhs = dem @ self.p["o"].T
        for d, tape, part in (("f", tf, dhs[:, :, :self.h]), ("b", tb, dhs[:, :, self.h:])):
            self._lstm_grads(x, d, tape, part, g)
        return loss, g

    def _lstm_grads(self, x, d, tape, dhs, g) -> None:
        h = self.h
        dnow, dcell = np.zeros_like(dhs[0]), np.zeros_like(dhs[0])
        dtable = np.zeros((ALPHABET, 4 * h))
        for k, prev, cell, i, f, gg, o, tc in reversed(tape):
            dnow = dnow + dhs[k]
            open_ = lambda x, low: (x > low) & (x < 1)  # noqa: E731 - where a cut function still rises
            dc = dcell + dnow * o * open_(tc, -1)
            da = np.concatenate((0.25 * dc * gg * open_(i, 0), 0.25 * dc * cell * open_(f, 0), dc * i * open_(gg, -1),
                                 0.25 * dnow * tc * open_(o, 0)), axis=1)
            g[d + "h"] += prev.T @ da
            np.add.at(dtable, x[:, k], da)
            dnow, dcell = da @ self.p[d + "h"].T, dc * f
        g[d + "c"] += dtable.sum(axis=0)
        g[d + "x"] += self.p["e"].T @ dtable
        g["e"] += dtable @ self.p[d + "x"].T

    def _packed(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of both directions, gates i f o g in rows: of the state, the embedding and a one; of the emissions.

        Emissions are taken relative to tag 0, which changes all paths alike.
        """
        h = self.h
        order = np.concatenate((np.arange(2 * h), np.arange(3 * h, 4 * h), np.arange(2 * h, 3 * h)))
        slope, shift = np.repeat([0.25, 0.25, 0.25, 1], h)[:, None], np.repeat([0.5, 0.5, 0.5, 0], h)[:, None]
        w = [np.hstack((self.p[d + "h"].T[order] * slope, self.p[d + "x"].T[order] * slope,
                        self.p[d + "c"][order][:, None] * slope + shift)) for d in "fb"]
        o = (self.p["o"] - self.p["o"][:, :1])[:, 1:].T
        return np.stack(w).astype(np.float32), np.stack((o[:, :h], o[:, h:])).astype(np.float32)

    def _light(self, x: np.ndarray) -> np.ndarray:
        """The emissions (t, tags - 1, n) relative to tag 0 in single precision.

        Both directions go together, one from each end, with windows along the last axis: one product gives
        all gates, and bounds are arrays of full size, which numpy compares several times faster than numbers.
        """
        n, t = x.shape
        h = self.h
        w, o = self._packed()
        e = self.p["e"].T.astype(np.float32)
        e = np.ascontiguousarray(e)
        d = len(e)
        x = np.ascontiguousarray(x.T.astype(np.intp))
        fed = np.zeros((2, h + d + 1, n), np.float32)
        fed[:, h + d] = 1
        now, ahead, back = fed[:, :h], fed[0, h:h + d], fed[1, h:h + d]
        a, cell, new = np.empty((2, 4 * h, n), np.float32), np.zeros((2, h, n), np.float32), np.empty((2, h, n), np.float32)
        take, keep, show, fresh = (a[:, j * h:(j + 1) * h] for j in range(4))
        low, high = np.zeros_like(a), np.ones_like(a)
        low[:, 3 * h:] = -1
        least, most = np.full_like(cell, -1), np.ones_like(cell)
        em = np.empty((t, 2, self.tags - 1, n), np.float32)
        for k in range(t):
            e.take(x[k], axis=1, out=ahead, mode="clip")
            e.take(x[t - 1 - k], axis=1, out=back, mode="clip")
            np.matmul(w, fed, out=a)
            np.maximum(a, low, out=a)
            np.minimum(a, high, out=a)
            np.multiply(cell, keep, out=cell)
            np.multiply(take, fresh, out=new)
            np.add(cell, new, out=cell)
            np.maximum(cell, least, out=new)
            np.minimum(new, most, out=new)
            np.multiply(new, show, out=now)
            np.matmul(o, now, out=em[k])
        em[:, 0] += em[::-1, 1]
        em[:, 0] += (self.p["ob"][1:] - self.p["ob"][0]).astype(np.float32)[:, None]
        return em[:, 0]

    def quiet(self, x: np.ndarray, least: float = 0.55) -> np.ndarray:
        """Which windows' path of tag 0 throughout has more than ``least`` of the probability.

        Weights of paths are taken relative to that path, so its probability is one by their sum. Above a
        half it is the best path (0.55 leaves room for single precision).
        """
        em = self._light(x)
        with np.errstate(over="ignore", invalid="ignore"):
            em = np.exp(em)
            step = np.exp(self.p["t"] - self.p["t"][0, 0]).T.astype(np.float32)
            at = np.ones((self.tags, len(x)), np.float32) * np.exp(self.p["s"] - self.p["s"][0]).astype(np.float32)[:, None]
            at[1:] *= em[0]
            for k in range(1, len(em)):
                at = step @ at
                at[1:] *= em[k]
            return at.sum(axis=0) < 1 / least

    def fit(self, x, y, epochs: int = 10, batch: int = 48, rate: float = 0.02, seed: int = 1) -> BiLstmCrf:
        rng = np.random.default_rng(seed)
        adam = Adam(self.p, rate)
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
                adam.step(self.loss_and_grads(x[part], y[part])[1])
        return self

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (n, t) and the marginal probability of each."""
        n, t = x.shape
        em = np.zeros((t, n, self.tags))
        em[:, :, 1:] = self._light(x).transpose(0, 2, 1)
        score, back = em[0] + self.p["s"], []
        for k in range(1, t):
            s = score[:, :, None] + self.p["t"]
            back.append(s.argmax(axis=1))
            score = s.max(axis=1) + em[k]
        path = np.empty((n, t), np.int64)
        path[:, -1] = score.argmax(axis=1)
        rows = np.arange(n)
        for k in range(t - 2, -1, -1):
            path[:, k] = back[k][rows, path[:, k + 1]]
        return path, np.take_along_axis(self._marginals(em).transpose(1, 0, 2), path[:, :, None], 2)[:, :, 0]

    def _marginals(self, em: np.ndarray) -> np.ndarray:
        """Probabilities (t, n, tags): weights forward and backward, scaled at every step, so that no logarithm is taken."""
        step = np.exp(self.p["t"] - self.p["t"].max())
        weight = np.exp(em - em.max(axis=2, keepdims=True))
        alpha, beta = np.empty_like(em), np.ones_like(em)
        first = em[0] + self.p["s"]
        alpha[0] = np.exp(first - first.max(axis=1, keepdims=True))
        for k in range(1, len(em)):
            at = (alpha[k - 1] @ step) * weight[k]
            np.divide(at, at.max(axis=1, keepdims=True), out=alpha[k])
        for k in range(len(em) - 2, -1, -1):
            at = (beta[k + 1] * weight[k + 1]) @ step.T
            np.divide(at, at.max(axis=1, keepdims=True), out=beta[k])
        alpha *= beta
        return alpha / alpha.sum(axis=2, keepdims=True)
