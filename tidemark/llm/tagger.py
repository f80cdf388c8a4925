"""Character-level bidirectional LSTM with CRF transitions, in numpy.

Tags are O and B-/I- of each kind. Training maximises the likelihood of the
labelled tag paths; decoding gives max-marginals, the score of the best path
through each tag at each position, so that overlapping windows can be merged.
"""

from __future__ import annotations

import numpy as np

WINDOW, STRIDE = 96, 48
HIDDEN = 20
_PAD, _SPACE, _LETTER, _OTHER = 0, 1, 2, 3
_NEVER = -1e4
_VETO = 25.0


def encode(text: str) -> np.ndarray:
    """Printable ASCII marks and letters (in either case) have codes of their
    own; digits, white space, non-ASCII letters and the rest have one each.
    Which digits an item has says nothing about where it begins and ends."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    raw = np.where((raw >= 65) & (raw <= 90), raw + 32, np.where((raw >= 48) & (raw <= 57), 48, raw))
    code = np.where((raw > 32) & (raw < 127), raw - 29, _OTHER).astype(np.int64)
    code[(raw == 32) | ((raw >= 9) & (raw <= 13)) | (raw == 0xA0)] = _SPACE
    code[raw >= 0xAA] = _LETTER
    return code


SYMBOLS = 127 - 29


def window_starts(n: int) -> np.ndarray:
    """Starts of the overlapping windows over a text of ``n`` characters."""
    return np.arange(0, max(1, n - STRIDE), STRIDE) if n > WINDOW else np.zeros(1, np.int64)


def cut(code: np.ndarray, starts: np.ndarray) -> np.ndarray:
    padded = np.concatenate([code, np.full(WINDOW, _PAD)])
    return padded[starts[:, None] + np.arange(WINDOW)[None, :]]


class Tagger:
    """Parameters and passes. ``w``: input (both directions), ``u``: state,
    ``v``: output, ``b``: output bias, ``t``: transitions."""

    def __init__(self, kinds: tuple[str, ...], seed: int = 3):
        self.kinds, k = kinds, 1 + 2 * len(kinds)
        rng = np.random.default_rng(seed)
        self.p = {
            "w": rng.normal(0, 0.3, (2, SYMBOLS, 4 * HIDDEN)).astype(np.float32),
            "u": (rng.normal(0, 1, (2, HIDDEN, 4 * HIDDEN)) / np.sqrt(HIDDEN)).astype(np.float32),
            "v": (rng.normal(0, 1, (2, HIDDEN, k)) / np.sqrt(HIDDEN)).astype(np.float32),
            "b": np.zeros(k, np.float32), "t": np.zeros((k, k), np.float32)}
        self.p["w"][:, :, HIDDEN:2 * HIDDEN] += 1  # remember by default
        # an I tag only follows its own B or I
        self.allowed = np.ones((k, k), bool)
        for i in range(len(kinds)):
            inner = 2 + 2 * i
            self.allowed[:, inner] = False
            self.allowed[[inner - 1, inner], inner] = True
        self.first = np.array([not (j and j % 2 == 0) for j in range(k)])

    def transitions(self) -> np.ndarray:
        return np.where(self.allowed, self.p["t"], _NEVER)

    def emissions(self, x: np.ndarray, trace: list | None = None) -> np.ndarray:
        """Tag scores of each character of the windows ``x`` (n, WINDOW)."""
        both = np.stack([x, x[:, ::-1]])
        n, steps, h = len(x), x.shape[1], HIDDEN
        state, cell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
        out = np.empty((2, steps, n, h), np.float32)
        side = np.arange(2)[:, None]
        for s in range(steps):
            z = self.p["w"][side, both[:, :, s]] + state @ self.p["u"]
            gate = 0.5 + 0.5 * np.tanh(0.5 * z[:, :, :3 * h])
            new = np.tanh(z[:, :, 3 * h:])
            before, last = cell, state
            cell = gate[:, :, h:2 * h] * cell + gate[:, :, :h] * new
            bent = np.tanh(cell)
            state = gate[:, :, 2 * h:] * bent
            out[:, s] = state
            if trace is not None:
                trace.append((gate, new, before, bent, last))
        return (np.einsum("snh,hk->nsk", out[0], self.p["v"][0])
                + np.einsum("snh,hk->nsk", out[1, ::-1], self.p["v"][1]) + self.p["b"]), out

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of the tag paths ``y`` and its
        gradients."""
        trace: list = []
        e, out = self.emissions(x, trace)
        n, steps, k = e.shape
        h = HIDDEN
        tr = np.exp(self.transitions()).astype(np.float64)
        ee = np.exp(e - e.max(2, keepdims=True)).astype(np.float64)
        alpha, scale = np.empty((steps, n, k)), np.empty((steps, n))
        a = ee[:, 0]  # a window may begin inside a span
        for s in range(steps):
            if s:
                a = (alpha[s - 1] @ tr) * ee[:, s]
            scale[s] = a.sum(1)
            alpha[s] = a / scale[s][:, None]
        beta = np.ones((n, k))
        de = np.empty((n, steps, k))
        pairs = np.zeros((k, k))
        for s in range(steps - 1, -1, -1):
            de[:, s] = alpha[s] * beta
            if s:
                right = ee[:, s] * beta / scale[s][:, None]
                pairs += (alpha[s - 1].T @ right) * tr
                beta = right @ tr.T
        log_z = np.log(scale).sum() + e.max(2).astype(np.float64).sum()
        rows, cols = np.arange(n)[:, None], np.arange(steps)[None, :]
        gold = float(e[rows, cols, y].sum()) + float(self.transitions()[y[:, :-1], y[:, 1:]].sum())
        de[rows, cols, y] -= 1
        np.subtract.at(pairs, (y[:, :-1], y[:, 1:]), 1)
        de = (de / n).astype(np.float32)
        g = {"t": np.where(self.allowed, pairs / n, 0).astype(np.float32), "b": de.sum((0, 1)),
             "v": np.stack([np.einsum("snh,nsk->hk", out[0], de), np.einsum("snh,nsk->hk", out[1, ::-1], de)]),
             "w": np.zeros_like(self.p["w"]), "u": np.zeros_like(self.p["u"])}
        up = np.stack([de @ self.p["v"][0].T, (de @ self.p["v"][1].T)[:, ::-1]])  # (2, n, steps, h)
        both = np.stack([x, x[:, ::-1]])
        dh, dc = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
        for s in range(steps - 1, -1, -1):
            gate, new, before, bent, last = trace[s]
            i, f, o = gate[:, :, :h], gate[:, :, h:2 * h], gate[:, :, 2 * h:]
            dh = dh + up[:, :, s]
            dc = dc + dh * o * (1 - bent ** 2)
            dz = np.concatenate([dc * new * i * (1 - i), dc * before * f * (1 - f), dh * bent * o * (1 - o),
                                 dc * i * (1 - new ** 2)], axis=2)
            for d in range(2):
                np.add.at(g["w"][d], both[d, :, s], dz[d])
            g["u"] += np.swapaxes(last, 1, 2) @ dz
            dh, dc = dz @ np.swapaxes(self.p["u"], 1, 2), dc * f
        return (log_z - gold) / n, g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 10, batch: int = 48, rate: float = 0.012,
            seed: int = 3) -> list[float]:
        """Adam over shuffled batches; returns the loss of each epoch."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        q = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, losses = 0, []
        for epoch in range(epochs):
            order, total = rng.permutation(len(x)), 0.0
            for at in range(0, len(x), batch):
                rows = order[at:at + batch]
                loss, g = self.gradients(x[rows], y[rows])
                total += loss * len(rows)
                norm = np.sqrt(sum(float((v ** 2).sum()) for v in g.values()))
                step += 1
                now = rate * (1 - epoch / epochs) ** 0.7
                for k, v in g.items():
                    v = v * min(1.0, 5.0 / max(norm, 1e-9))
                    m[k] += 0.1 * (v - m[k])
                    q[k] += 0.005 * (v * v - q[k])
                    self.p[k] -= now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(q[k] / (1 - 0.995 ** step)) + 1e-7)
            losses.append(total / max(1, len(x)))
        return losses

    def max_marginals(self, x: np.ndarray) -> np.ndarray:
        """For each window, position and tag: the best path through it, less
        the best path (so 0 on the decoded path, negative elsewhere)."""
        e, _ = self.emissions(x)
        n, steps, k = e.shape
        tr = self.transitions().astype(np.float32)
        forward = np.empty((steps, n, k), np.float32)
        forward[0] = e[:, 0]
        for s in range(1, steps):
            forward[s] = (forward[s - 1][:, :, None] + tr).max(1) + e[:, s]
        back = np.zeros((n, k), np.float32)
        out = np.empty((n, steps, k), np.float32)
        for s in range(steps - 1, -1, -1):
            out[:, s] = forward[s] + back
            if s:
                back = (tr[None] + (e[:, s] + back)[:, None, :]).max(2)
        # bounded, so that no window can veto the others where they overlap
        return np.maximum(out - out.max(2, keepdims=True), -_VETO)

    def reconcile(self, starts: np.ndarray, scores: np.ndarray, n: int) -> list[tuple[str, int, int]]:
        """Spans of one stretch of overlapping windows, given at once."""
        stretch = Stretch(self, int(starts[0]), n)
        stretch.feed(starts, scores, True)
        return stretch.spans()


class Stretch:
    """One stretch of overlapping windows, fed in parts: scores are averaged,
    a position counting more the farther it is from a window's edge, and one
    path is decoded over the whole stretch, the same for any parts. Between
    parts only the scores of the last half window, the state of the search and
    the steps that are still open stay."""

    def __init__(self, tagger: Tagger, base: int, n: int):
        self.tagger, self.base, self.n = tagger, base, n
        k = len(tagger.first)
        self.hard = np.where(tagger.allowed, 0, _NEVER).astype(np.float32)
        self.weight = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)
        self.at = 0  # first position without a decided step, relative to the base
        self.total, self.sums = np.zeros((0, k), np.float32), np.zeros(0, np.float32)
        self.best: np.ndarray | None = None
        self.came = np.zeros((0, k), np.int8)
        self.tags: list[np.ndarray] = []

    def feed(self, starts: np.ndarray, scores: np.ndarray, last: bool) -> None:
        """The next windows; ``last``: the stretch ends with them."""
        size = int(starts[-1]) + WINDOW - self.base - self.at
        total, sums = np.zeros((size, scores.shape[2]), np.float32), np.zeros(size, np.float32)
        total[:len(self.total)], sums[:len(self.sums)] = self.total, self.sums
        for at, s in zip(starts - self.base - self.at, scores):
            total[at:at + WINDOW] += self.weight[:, None] * s
            sums[at:at + WINDOW] += self.weight
        # what the next window reaches waits for it
        ready = (min(int(starts[-1]) + WINDOW, self.n) if last else int(starts[-1]) + STRIDE) - self.base - self.at
        merged = total[:ready] / sums[:ready, None]
        self.total, self.sums, self.at = total[ready:], sums[ready:], self.at + ready
        came = np.zeros((ready, scores.shape[2]), np.int8)
        for s in range(ready):
            if self.best is None:
                self.best = merged[0] + np.where(self.tagger.first, 0, _NEVER)
                continue
            options = self.best[:, None] + self.hard
            came[s] = options.argmax(0)
            self.best = options.max(0) + merged[s]
        self.came = np.concatenate([self.came, came])
        self._settle(int(self.best.argmax()) if last else None)

    def _settle(self, tag: int | None) -> None:
        """Tags up to where all paths agree, or all with the last ``tag``."""
        s = len(self.came) - 1
        if tag is None:
            ends = np.arange(self.came.shape[1])
            while s >= 0 and (ends != ends[0]).any():
                ends = self.came[s][ends]
                s -= 1
            if s < 0:
                return
            tag = int(ends[0])
        tags = np.empty(s + 1, np.int8)
        self.came, came = self.came[s + 1:], self.came
        for i in range(s, -1, -1):
            tags[i] = tag
            tag = int(came[i, tag])
        self.tags.append(tags)

    def spans(self) -> list[tuple[str, int, int]]:
        tags = np.concatenate(self.tags)
        out = []
        for s in np.nonzero(tags % 2)[0].tolist():
            e = s + 1
            while e < len(tags) and tags[e] == tags[s] + 1:
                e += 1
            out.append((self.tagger.kinds[(int(tags[s]) - 1) // 2], self.base + s, self.base + e))
        return out
