"""A character-level bidirectional LSTM with CRF transitions, in numpy.

The LSTM's curves are the softsign x / (1 + |x|) where hyperbolic tangents are usual: of the same shape, at a fifth of the time, as every
character of every text is read.
"""

from __future__ import annotations

from functools import cache

import numpy as np

# Characters that have a symbol of their own, beside the small ASCII letters. Digits share one, as do capitals.
MARKS = "@.-+() \n%_/:\"=,'[]{}<>"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
DIGIT, CAPITAL, OTHER, BLANK = range(len(MARKS) + len(LETTERS), len(MARKS) + len(LETTERS) + 4)
SYMBOLS = BLANK + 1
HIDDEN = 12
NEVER = -1e4


@cache
def _table() -> np.ndarray:
    out = np.full(256, OTHER, np.uint8)
    out[48:58], out[65:91] = DIGIT, CAPITAL
    for i, c in enumerate(MARKS + LETTERS):
        out[ord(c)] = i
    return out


def symbols(text: str) -> np.ndarray:
    """One symbol for each code point."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return _table()[np.minimum(code, 255)]


def _curve(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place."""
    size = np.abs(x)
    size += 1
    x /= size
    return x


def _slope(y: np.ndarray) -> np.ndarray:
    """The slope of _curve() where it is y."""
    return (1 - np.abs(y)) ** 2


def _run(x: np.ndarray, into: np.ndarray, again: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (time, row, hidden) of an LSTM over symbols (time, row); gates are input, forget, output, new."""
    n, size = x.shape[1], again.shape[0]
    h, c = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
    out = np.empty((len(x), n, size), np.float32)
    table, turn = into.astype(np.float32), again.astype(np.float32)
    for t, now in enumerate(x):
        z = table[now]
        z += h @ turn
        _curve(z)
        new = z[:, 3 * size :]
        gate = z[:, : 3 * size]
        gate *= 0.5
        gate += 0.5
        i, f, o = gate[:, :size], gate[:, size : 2 * size], gate[:, 2 * size :]
        before, was = c, h
        c = f * c
        c += i * new
        curved = _curve(c.copy())
        h = np.multiply(o, curved, out=out[t])
        if keep is not None:
            keep.append((i, f, o, new, before, was, curved))
    return out


def _read(x: np.ndarray, into: np.ndarray, again: np.ndarray) -> np.ndarray:
    """The states of _run(), as (time, hidden, row): laid out so that each gate is one block, which is half as dear."""
    n, size = x.shape[1], again.shape[0]
    table, turn = np.ascontiguousarray(into.T, np.float32), np.ascontiguousarray(again.T, np.float32)
    z, more = np.empty((4 * size, n), np.float32), np.empty((4 * size, n), np.float32)
    i, f, o, gates, new = z[:size], z[size : 2 * size], z[2 * size : 3 * size], z[: 3 * size], z[3 * size :]
    c, h, room = np.zeros((size, n), np.float32), np.zeros((size, n), np.float32), np.empty((size, n), np.float32)
    out = np.empty((len(x), size, n), np.float32)
    for t, now in enumerate(x):
        np.take(table, now, axis=1, out=z, mode="clip")
        np.matmul(turn, h, out=more)
        z += more
        np.abs(z, out=more)
        more += 1
        z /= more
        gates += 1  # twice what they are; halves follow
        c *= f
        new *= i
        c += new
        c *= 0.5
        np.abs(c, out=room)
        room += 1
        h = np.divide(c, room, out=out[t])
        h *= o
        h *= 0.5
    return out


def _back(x: np.ndarray, grad: np.ndarray, again: np.ndarray, keep: list, into_shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of _run()'s weights from those of its states."""
    d_into, d_again = np.zeros(into_shape, np.float32), np.zeros_like(again)
    d_h, d_c = np.zeros_like(grad[0]), np.zeros_like(grad[0])
    for t in range(len(x) - 1, -1, -1):
        i, f, o, new, before, was, curved = keep[t]
        d_h = d_h + grad[t]
        d_c = d_c + d_h * o * _slope(curved)
        gate = lambda g: 0.5 * _slope(2 * g - 1)  # noqa: E731  a gate is half a curve and a half
        d_z = np.concatenate([d_c * new * gate(i), d_c * before * gate(f), d_h * curved * gate(o), d_c * i * _slope(new)], axis=1)
        np.add.at(d_into, x[t], d_z)
        d_again += was.T @ d_z
        d_h, d_c = d_z @ again.T, d_c * f
    return d_into, d_again


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


class Tagger:
    """Tags characters: 0 outside; 1 + 2k and 2 + 2k begin and continue a span of kind k, which the transitions enforce."""

    def __init__(self, n_tags: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.w = {
            "into_f": rng.normal(0, 0.3, (SYMBOLS, 4 * HIDDEN)), "again_f": rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)),
            "into_b": rng.normal(0, 0.3, (SYMBOLS, 4 * HIDDEN)), "again_b": rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)),
            "out": rng.normal(0, 0.2, (2 * HIDDEN, n_tags)), "bias": np.zeros(n_tags), "moves": np.zeros((n_tags, n_tags)),
        }
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}
        for side in "fb":
            self.w[f"into_{side}"][:, HIDDEN : 2 * HIDDEN] += 1  # remember, to begin with
        allowed = np.ones((n_tags, n_tags), bool)
        for b in range(2, n_tags, 2):
            allowed[:, b] = False
            allowed[b - 1 : b + 1, b] = True
        self.barred = np.where(allowed, 0, NEVER).astype(np.float32)
        self.start = np.array([NEVER if t and t % 2 == 0 else 0 for t in range(n_tags)], np.float32)

    def emissions(self, x: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Scores (time, row, tag) and the states below them, of symbols (row, time)."""
        s = x.T
        f = _run(s, self.w["into_f"], self.w["again_f"], keep and keep[0])
        b = _run(s[::-1], self.w["into_b"], self.w["again_b"], keep and keep[1])[::-1]
        states = np.concatenate([f, b], axis=2)
        return states @ self.w["out"] + self.w["bias"], states

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The windows (rows of x) with a tag other than 0, their best tags (Viterbi), and by how much each tag's score is above 0's."""
        scores = self._by_tag(x)
        moves = self.w["moves"] + self.barred
        rows = self._promising(scores, moves)
        if not len(rows):
            return rows, np.zeros((0, x.shape[1]), np.int64), np.zeros((0, x.shape[1]), np.float32)
        scores = np.ascontiguousarray(scores[:, :, rows].transpose(1, 2, 0))
        best, back = scores[0] + self.start, []
        for now in scores[1:]:
            ways = best[:, :, None] + moves
            back.append(ways.argmax(axis=1))
            best = ways.max(axis=1) + now
        tag = best.argmax(axis=1)
        out, n = np.zeros((len(rows), x.shape[1]), np.int64), np.arange(len(rows))
        out[:, -1] = tag
        for t in range(len(back) - 1, -1, -1):
            tag = back[t][n, tag]
            out[:, t] = tag
        some = np.flatnonzero(out.any(axis=1))
        own = np.take_along_axis(scores, out.T[:, :, None], axis=2)[:, :, 0] - scores[:, :, 0]
        return rows[some], out[some], own.T[some]

    def _by_tag(self, x: np.ndarray) -> np.ndarray:
        """Scores (tag, time, row), as emissions() has them."""
        s, out = x.T.astype(np.intp), self.w["out"].T.astype(np.float32)
        half = out.shape[1] // 2
        scores = np.matmul(out[:, :half], _read(s, self.w["into_f"], self.w["again_f"]))
        scores += np.matmul(out[:, half:], _read(s[::-1], self.w["into_b"], self.w["again_b"])[::-1])
        scores += self.w["bias"].astype(np.float32)[:, None]
        return scores.transpose(1, 0, 2)

    def _promising(self, scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
        """The rows whose best tags may be other than zeros; for the rest that is ruled out.

        What the best span of each kind up to each character gains over zeros, but that a span may begin after any other at the price of the
        cheapest move: a bound that is all but the gain itself.
        """
        still = moves[0, 0]
        begin, on = scores[1::2] - scores[0], scores[2::2] - scores[0]
        enter, leave = (moves[:, 1::2].max(axis=0) - still)[:, None], float(moves[1:, 0].max() - still)
        kinds = np.arange(len(begin))
        first, again = (moves[1 + 2 * kinds, 2 + 2 * kinds] - still)[:, None], (moves[2 + 2 * kinds, 2 + 2 * kinds] - still)[:, None]
        b, i = begin[:, 0], np.full_like(begin[:, 0], NEVER)
        end = b.max(axis=0)
        most = end + leave
        for t in range(1, begin.shape[1]):
            b, i = np.maximum(end, 0) + enter + begin[:, t], np.maximum(b + first, i + again) + on[:, t]
            end = np.maximum(b, i).max(axis=0)
            np.maximum(most, end + leave, out=most)
        return np.flatnonzero(np.maximum(most, end) > -1e-4)

    def _loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of a batch, and its gradients."""
        keep: tuple[list, list] = ([], [])
        scores, states = self.emissions(x, keep)
        moves, n, length = self.w["moves"] + self.barred, np.arange(len(x)), x.shape[1]
        ahead, behind = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0] + self.start
        for t in range(1, length):
            ahead[t] = _logsum(ahead[t - 1][:, :, None] + moves, 1) + scores[t]
        for t in range(length - 2, -1, -1):
            behind[t] = _logsum(moves[None] + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
        whole = _logsum(ahead[-1], 1)
        d_scores = np.exp(ahead + behind - whole[None, :, None])
        d_moves = np.zeros_like(moves)
        for t in range(1, length):
            d_moves += np.exp(ahead[t - 1][:, :, None] + moves + (scores[t] + behind[t])[:, None, :] - whole[:, None, None]).sum(axis=0)
            np.add.at(d_moves, (y[:, t - 1], y[:, t]), -1)
        true = self.start[y[:, 0]] + sum(scores[t][n, y[:, t]] for t in range(length)) + sum(moves[y[:, t - 1], y[:, t]] for t in range(1, length))
        for t in range(length):
            d_scores[t][n, y[:, t]] -= 1
        d_scores, d_moves = d_scores / len(x), d_moves / len(x)
        d_states = d_scores @ self.w["out"].T
        s = x.T
        into_f, again_f = _back(s, d_states[:, :, :HIDDEN], self.w["again_f"], keep[0], self.w["into_f"].shape)
        into_b, again_b = _back(s[::-1], d_states[::-1, :, HIDDEN:], self.w["again_b"], keep[1], self.w["into_b"].shape)
        out = np.einsum("tnh,tnk->hk", states, d_scores)
        return float((whole - true).mean()), {"into_f": into_f, "again_f": again_f, "into_b": into_b, "again_b": again_b, "out": out, "bias": d_scores.sum(axis=(0, 1)), "moves": d_moves}

    @classmethod
    def fitted(cls, x: np.ndarray, y: np.ndarray, n_tags: int, *, epochs: int = 6, rows: int = 48, rate: float = 0.02, seed: int = 5) -> Tagger:
        """Adam over shuffled batches of windows x and tags y (row, time)."""
        tagger, rng, step = cls(n_tags, seed), np.random.default_rng(seed), 0
        y = y.copy()
        y[:, 0] = np.where((y[:, 0] > 0) & (y[:, 0] % 2 == 0), y[:, 0] - 1, y[:, 0])  # a window may begin inside a span
        m, v = ({k: np.zeros_like(w) for k, w in tagger.w.items()} for _ in range(2))
        for _ in range(max(epochs, -(-60 * rows // len(x)))):
            order = rng.permutation(len(x))
            for at in range(0, len(x), rows):
                step += 1
                _, grad = tagger._loss(x[order[at : at + rows]], y[order[at : at + rows]])
                size = np.sqrt(sum(float((g.astype(np.float64) ** 2).sum()) for g in grad.values()))
                shrink = min(1.0, 5.0 / (size + 1e-9))
                for k, g in grad.items():
                    g = (g * shrink).astype(np.float32)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    tagger.w[k] = (tagger.w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return tagger
