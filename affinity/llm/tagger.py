"""A character-level bidirectional LSTM with a CRF on top, in numpy.

Small on purpose: it is trained on the driver from a bounded sample in seconds, and its
parameters (some 20,000 numbers) travel to the tasks by broadcast.
"""

from __future__ import annotations

import numpy as np

# Characters: ASCII, any other, and padding.
OTHER, PAD = 128, 129
HIDDEN = 16
# How much better a path must be to be taken without a search; sums of 288 scores are rounded by far less.
SURE = 0.25
# What a state of ``_by_tangent`` and of ``_by_exponential`` is in true ones, and the factors of the
# arguments of sigmoids and of tangents there.
TANGENT, EXPONENTIAL = (2, 0.5, 1), (1, -1, -2)
# numpy's tangents of 32-bit numbers are vectors with AVX-512 only, its exponentials without it too.
FAST_TANGENT = "AVX512_SKX" in np.show_config(mode="dicts")["SIMD Extensions"].get("found", ())
# Windows that are scored together, few enough that a step's numbers stay in a core's cache.
SCORED = 512


def codes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.minimum(raw, OTHER).astype(np.uint8)


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _lse(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _by_tangent(z, cell, part, state) -> None:
    """The next cell, and twice the next state, from halves of sigmoids' arguments and from those of tangents.

    A sigmoid is half of a hyperbolic tangent of half its argument, and a half. Gates are kept at twice
    their value: halving them is left to the weights and to the cell, and exact.
    """
    i, f, o, g = z
    np.tanh(z, out=z)
    z[:3] += 1
    np.multiply(i, g, out=part)
    cell *= f
    cell += part
    cell *= 0.5
    np.tanh(cell, out=part)
    np.multiply(o, part, out=state)


def _by_exponential(z, cell, part, state) -> None:
    """The next cell at -2 times its value, and the next state, from -1 and -2 times the arguments.

    A sigmoid is 1 / (1 + exp(-a)) and tanh(a) is 2 / (1 + exp(-2a)) - 1, also where the exponential is infinite.
    """
    i, f, o, g = z
    np.exp(z, out=z)
    z += 1
    np.divide(4, g, out=part)
    np.subtract(2, part, out=part)
    part /= i
    cell /= f
    cell += part
    np.exp(cell, out=part)
    part += 1
    np.divide(2, part, out=part)
    part -= 1
    np.divide(part, o, out=state)


class Tagger:
    def __init__(self, n_tags: int, seed: int = 7):
        random = np.random.default_rng(seed)
        draw = lambda *shape: (random.standard_normal(shape) * 0.2).astype(np.float32)
        h = HIDDEN
        self.n_tags = n_tags
        self.p = {
            "in_f": draw(PAD + 1, 4 * h), "rec_f": draw(h, 4 * h),
            "in_b": draw(PAD + 1, 4 * h), "rec_b": draw(h, 4 * h),
            "out": draw(2 * h, n_tags), "bias": np.zeros(n_tags, np.float32),
            "trans": draw(n_tags, n_tags), "first": draw(n_tags),
        }
        for side in "fb":
            self.p[f"in_{side}"][:, h : 2 * h] += 1  # gates start open to what was

    def _lstm(self, x, side, keep):
        """Outputs (time, windows, hidden) of one direction, and what training needs of it."""
        h, (t_max, n) = HIDDEN, x.shape
        gates_in, rec = self.p[f"in_{side}"], self.p[f"rec_{side}"]
        out = np.zeros((t_max, n, h), np.float32)
        state = np.zeros((n, h), np.float32)
        cell = np.zeros((n, h), np.float32)
        memory = []
        for t in range(t_max) if side == "f" else range(t_max - 1, -1, -1):
            z = gates_in[x[t]] + state @ rec
            s = _sigmoid(z[:, : 3 * h])
            g = np.tanh(z[:, 3 * h :])
            i, f, o = s[:, :h], s[:, h : 2 * h], s[:, 2 * h :]
            new = f * cell + i * g
            squashed = np.tanh(new)
            if keep:
                memory.append((t, i, f, o, g, cell, squashed, state))
            cell, state = new, o * squashed
            out[t] = state
        return out, memory

    def _lstm_back(self, x, side, memory, d_out, grad):
        h, rec = HIDDEN, self.p[f"rec_{side}"]
        d_state = np.zeros_like(d_out[0])
        d_cell = np.zeros_like(d_state)
        d_in = np.empty((*x.shape, 4 * h), np.float32)
        for t, i, f, o, g, cell, squashed, before in reversed(memory):
            d = d_out[t] + d_state
            d_c = d_cell + d * o * (1 - squashed * squashed)
            dz = np.concatenate(
                [d_c * g * i * (1 - i), d_c * cell * f * (1 - f), d * squashed * o * (1 - o), d_c * i * (1 - g * g)],
                axis=1,
            )
            d_in[t] = dz
            grad[f"rec_{side}"] += before.T @ dz
            d_state, d_cell = dz @ rec.T, d_c * f
        order = np.argsort(x, axis=None, kind="stable")
        code, first = np.unique(x.ravel()[order], return_index=True)
        grad[f"in_{side}"][code] += np.add.reduceat(d_in.reshape(-1, 4 * h)[order], first)

    def _emissions(self, x, keep=False):
        forward, memory_f = self._lstm(x, "f", keep)
        backward, memory_b = self._lstm(x, "b", keep)
        both = np.concatenate([forward, backward], axis=2)
        return both @ self.p["out"] + self.p["bias"], both, memory_f, memory_b

    def loss(self, x, y, grad=None) -> float:
        """Mean negative log-likelihood of the tags ``y`` (time, windows); adds to ``grad``."""
        e, both, memory_f, memory_b = self._emissions(x, keep=grad is not None)
        t_max, n = x.shape
        trans, first = self.p["trans"], self.p["first"]
        alpha = np.empty_like(e)
        alpha[0] = first + e[0]
        for t in range(1, t_max):
            alpha[t] = e[t] + _lse(alpha[t - 1][:, :, None] + trans, 1)
        total = _lse(alpha[-1], 1)
        rows = np.arange(n)
        gold = first[y[0]] + e[np.arange(t_max)[:, None], rows, y].sum(axis=0) + trans[y[:-1], y[1:]].sum(axis=0)
        if grad is not None:
            beta = np.zeros_like(e)
            d_trans = np.zeros_like(trans)
            for t in range(t_max - 1, 0, -1):
                step = e[t] + beta[t]
                pair = alpha[t - 1][:, :, None] + trans + step[:, None, :] - total[:, None, None]
                d_trans += np.exp(pair).sum(axis=0)
                beta[t - 1] = _lse(trans + step[:, None, :], 2)
            d = np.exp(alpha + beta - total[:, None])
            grad["first"] += (d[0].sum(axis=0) - np.bincount(y[0], minlength=self.n_tags)) / n
            np.subtract.at(d_trans, (y[:-1].ravel(), y[1:].ravel()), 1)
            grad["trans"] += d_trans / n
            d[np.arange(t_max)[:, None], rows, y] -= 1
            d = (d / n).astype(np.float32)
            flat = d.reshape(-1, self.n_tags)
            grad["out"] += both.reshape(len(flat), -1).T @ flat
            grad["bias"] += flat.sum(axis=0)
            d_both = d @ self.p["out"].T
            self._lstm_back(x, "f", memory_f, d_both[:, :, :HIDDEN], grad)
            self._lstm_back(x, "b", memory_b, d_both[:, :, HIDDEN:], grad)
        return float((total - gold).mean())

    def train(self, x, y, steps: int, batch: int = 96, rate: float = 0.04, seed: int = 11) -> Tagger:
        """Adam over random batches of the windows ``x`` with tags ``y``, both (windows, time)."""
        random = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            chosen = random.integers(0, len(x), min(batch, len(x)))
            grad = {k: np.zeros_like(v) for k, v in self.p.items()}
            self.loss(x[chosen].T, y[chosen].T, grad)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            now = rate * (1 - 0.9 * step / steps)
            for k, g in grad.items():
                g *= min(1.0, 5 / (norm + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                self.p[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def _scores(self, x) -> np.ndarray:
        """The emissions (time, windows, tags), both directions in one pass and without memory.

        They lie in memory as (time, tags, windows). Outputs become emissions at once, so that a step
        works on little more than its gates.
        """
        h, (t_max, n) = HIDDEN, x.shape
        # Each gate is one block of memory, for both directions and all windows.
        step, (times, *factors) = (_by_tangent, TANGENT) if FAST_TANGENT else (_by_exponential, EXPONENTIAL)
        scale = np.repeat(np.float32(factors), [3 * h, h])
        given = np.concatenate([self.p["in_f"], self.p["in_b"]]) * scale
        given = np.ascontiguousarray(given.reshape(-1, 4, h).transpose(1, 0, 2))
        rec = np.stack([self.p["rec_f"], self.p["rec_b"]]) * (scale / times)
        rec = np.ascontiguousarray(rec.reshape(2, h, 4, h).transpose(2, 0, 1, 3))
        weights = self.p["out"].reshape(2, h, self.n_tags) / np.float32(times)
        at = np.stack([x, x[::-1]], axis=1).astype(np.uint16)
        at[:, 1] += PAD + 1
        now = np.empty((2, n), np.intp)
        state, cell, part, taken = np.zeros((4, 2, n, h), np.float32)
        z = np.empty((4, 2, n, h), np.float32)
        both = np.empty((2, n, self.n_tags), np.float32)
        e = np.zeros((t_max, n, self.n_tags), np.float32)
        with np.errstate(over="ignore"):
            for t in range(t_max):
                np.copyto(now, at[t])
                np.matmul(state, rec, out=z)
                for table, gate in zip(given, z, strict=True):
                    table.take(now, axis=0, out=taken, mode="clip")
                    gate += taken
                step(z, cell, part, state)
                np.matmul(state, weights, out=both)
                e[t] += both[0]
                e[t_max - 1 - t] += both[1]
        e = np.ascontiguousarray(e.transpose(0, 2, 1))
        e += self.p["bias"][:, None]
        return e.transpose(0, 2, 1)

    def _surely_outside(self, e) -> np.ndarray:
        """Windows in which tag 0 throughout is better, beyond any rounding, than all other tags.

        All other tags count as one, with the best score and the best ways of any of them. What its best
        path has gained on that of tag 0 must be less than the way back costs, at every character,
        and nothing at the last.
        """
        trans, first = self.p["trans"], self.p["first"]
        into = trans[0, 1:].max() - trans[0, 0]
        on = trans[1:, 1:].max() - trans[0, 0]
        back = trans[1:, 0].max() - trans[0, 0]
        ahead = e[:, 1:].max(axis=1) - e[:, 0]
        # Staying from the first character to each, and the best place to have come from tag 0 or to have begun.
        begun = ahead[0] + (first[1:].max() - first[0])
        stayed = ahead + on
        stayed[0] = 0
        np.cumsum(stayed, axis=0, out=stayed)
        best = np.empty_like(ahead)
        best[0] = begun
        np.subtract(into - on, stayed[:-1], out=best[1:])
        np.maximum.accumulate(best, axis=0, out=best)
        best += stayed
        return np.maximum(best[:-1].max(axis=0, initial=-np.inf) + back, best[-1]) < -SURE

    def decode(self, x) -> np.ndarray:
        """The best tags (windows, time) of windows of characters ``x``, by Viterbi.

        Scores are kept by tag and window, and the best way into a tag is looked for only where the
        best path takes it. Of equal ways the smaller tag counts. Windows that are surely
        outside of all spans need no search. Any number of windows is taken: they are scored in equal parts
        of ``SCORED`` at most, and those to be searched wait for each other.
        """
        out = np.zeros(x.shape, np.int8)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def search() -> None:
            if waiting:
                rows, scores = zip(*waiting, strict=True)
                out[np.concatenate(rows)] = self._search(np.concatenate(scores, axis=2))
                waiting.clear()

        for rows in np.array_split(np.arange(len(x)), max(1, -(-len(x) // SCORED))):
            e = self._scores(x[rows].T).transpose(0, 2, 1)
            open_ = np.flatnonzero(~self._surely_outside(e))
            if len(open_):
                waiting.append((rows[open_], e[:, :, open_]))
            if sum(len(r) for r, _ in waiting) >= SCORED:
                search()
        search()
        return out

    def _search(self, e) -> np.ndarray:
        t_max, k, n = e.shape
        trans = self.p["trans"]
        best = np.empty_like(e)
        best[0] = self.p["first"][:, None] + e[0]
        pair = np.empty((k, k, n), np.float32)
        for t in range(1, t_max):
            np.add(best[t - 1][:, None], trans[:, :, None], out=pair)
            np.max(pair, axis=0, out=best[t])
            best[t] += e[t]
        out = np.empty((n, t_max), np.int8)
        out[:, -1] = best[-1].argmax(axis=0)
        for t in range(t_max - 1, 0, -1):
            out[:, t - 1] = (best[t - 1] + trans[:, out[:, t]]).argmax(axis=0)
        return out
