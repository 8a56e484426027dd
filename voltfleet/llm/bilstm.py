"""A character tagger in numpy: a bidirectional LSTM with a CRF on top.

Texts are rows of character numbers. Training is Adam on the CRF's negative log
likelihood; all random numbers come from one seed, so equal samples give equal models.
"""

from __future__ import annotations

import numpy as np

#: Character numbers: ASCII as it is, then letters, digits and others beyond ASCII, and padding.
OTHER, PAD, SYMBOLS = 128, 129, 130


def numbers(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.where(code < 128, code, OTHER).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(chars: np.ndarray, x: np.ndarray, u: np.ndarray, keep: bool):
    """States of one direction; with keep also what the way back needs."""
    rows, steps = chars.shape
    size = u.shape[0]
    h, c = np.zeros((rows, size), x.dtype), np.zeros((rows, size), x.dtype)
    out = np.empty((rows, steps, size), x.dtype)
    tape = []
    for t in range(steps):
        z = x[chars[:, t]] + h @ u
        gate = _sigmoid(z[:, : 3 * size])
        i, f, o = gate[:, :size], gate[:, size : 2 * size], gate[:, 2 * size :]
        g = np.tanh(z[:, 3 * size :])
        before, c = c, f * c + i * g
        squashed = np.tanh(c)
        last, h = h, o * squashed
        out[:, t] = h
        if keep:
            tape.append((i, f, o, g, before, squashed, last))
    return out, tape


def _back(chars, u, tape, grad) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input and the recurrent weights of one direction."""
    rows, steps, size = grad.shape
    dh, dc = np.zeros((rows, size), grad.dtype), np.zeros((rows, size), grad.dtype)
    dz = np.empty((steps, rows, 4 * size), grad.dtype)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, before, squashed, _ = tape[t]
        dh = dh + grad[:, t]
        dc = dc + dh * o * (1 - squashed**2)
        z = dz[t]
        z[:, :size] = dc * g * i * (1 - i)
        z[:, size : 2 * size] = dc * before * f * (1 - f)
        z[:, 2 * size : 3 * size] = dh * squashed * o * (1 - o)
        z[:, 3 * size :] = dc * i * (1 - g**2)
        dh, dc = z @ u.T, dc * f
    flat = dz.reshape(-1, 4 * size)
    hot = np.zeros((len(flat), SYMBOLS), grad.dtype)
    hot[np.arange(len(flat)), chars.T.ravel()] = 1
    last = np.concatenate([x[6] for x in tape])
    return hot.T @ flat, last.T @ flat


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Tagger:
    def __init__(self, tags: int, allowed: np.ndarray, hidden: int = 16, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.tags, self.hidden, self.rng = tags, hidden, rng
        self.barred = np.where(allowed, 0.0, -1e4).astype(np.float32)

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.w = {
            "xf": normal(SYMBOLS, 4 * hidden, scale=0.3), "uf": normal(hidden, 4 * hidden, scale=0.2),
            "xb": normal(SYMBOLS, 4 * hidden, scale=0.3), "ub": normal(hidden, 4 * hidden, scale=0.2),
            "out": normal(2 * hidden, tags, scale=0.2), "bias": np.zeros(tags, np.float32),
            "trans": np.zeros((tags, tags), np.float32),
        }

    def emissions(self, chars: np.ndarray) -> np.ndarray:
        """Scores of (tag, row, step). Both directions run at once, each gate's states end to end."""
        w, size = self.w, self.hidden
        rows, steps = chars.shape
        out = np.empty((steps, rows, self.tags), np.float32)
        out[:] = w["bias"]
        line = np.ascontiguousarray(chars.T).astype(np.intp)
        # A gate is (1 + tanh(z / 2)) / 2: the inner half is in its weights, the outer one in what reads c and h.
        half = np.where(np.arange(4 * size) < 3 * size, 0.5, 1).astype(np.float32)

        def by_gate(ahead: np.ndarray, back: np.ndarray) -> np.ndarray:
            return np.ascontiguousarray((np.stack([ahead, back]) * half).reshape(2, -1, 4, size).transpose(0, 2, 1, 3))

        x, u = by_gate(w["xf"], w["xb"]), by_gate(w["uf"], w["ub"]) * np.float32(0.5)
        proj = w["out"].reshape(2, size, -1) * np.float32(0.5)
        z, own = np.empty((2, 4, rows, size), np.float32), np.empty((2, 4, rows, size), np.float32)
        gates, (i, f, o, g) = z[:, :3], z.transpose(1, 0, 2, 3)
        h, c, score = np.zeros_like(g), np.zeros_like(g), np.empty((2, rows, self.tags), np.float32)
        for t in range(steps):
            np.matmul(h[:, None], u, out=z)
            np.take(x[0], line[t], axis=1, out=own[0], mode="clip")
            np.take(x[1], line[-1 - t], axis=1, out=own[1], mode="clip")
            z += own
            np.tanh(z, out=z)
            gates += 1
            c *= f
            g *= i
            c += g
            c *= np.float32(0.5)
            np.tanh(c, out=h)
            h *= o
            np.matmul(h, proj, out=score)
            for place, more in ((out[t], score[0]), (out[-1 - t], score[1])):
                place += more
        return np.ascontiguousarray(out.transpose(2, 1, 0))

    def _gradients(self, chars: np.ndarray, gold: np.ndarray) -> dict[str, np.ndarray]:
        w, grads = self.w, {k: np.zeros_like(v) for k, v in self.w.items()}
        ahead, tape_f = _run(chars, w["xf"], w["uf"], True)
        back, tape_b = _run(chars[:, ::-1], w["xb"], w["ub"], True)
        states = np.concatenate([ahead, back[:, ::-1]], axis=2)
        e = states @ w["out"] + w["bias"]
        rows, steps, k = e.shape
        trans = w["trans"] + self.barred
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for t in range(1, steps):
            alpha[:, t] = e[:, t] + _logsum(alpha[:, t - 1, :, None] + trans, 1)
        for t in range(steps - 2, -1, -1):
            beta[:, t] = _logsum(trans + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        total = _logsum(alpha[:, -1], 1)
        share = np.exp(alpha + beta - total[:, None, None])
        pair = np.exp(
            alpha[:, :-1, :, None] + trans + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]
        )
        grads["trans"] = pair.sum(axis=(0, 1))
        np.subtract.at(grads["trans"], (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
        ge = share
        ge[np.arange(rows)[:, None], np.arange(steps)[None, :], gold] -= 1
        ge, grads["trans"] = (ge / rows).astype(np.float32), (grads["trans"] / rows).astype(np.float32)
        grads["out"] = states.reshape(-1, states.shape[2]).T @ ge.reshape(-1, k)
        grads["bias"] = ge.sum(axis=(0, 1))
        gs = ge @ w["out"].T
        grads["xf"], grads["uf"] = _back(chars, w["uf"], tape_f, gs[:, :, : self.hidden])
        grads["xb"], grads["ub"] = _back(chars[:, ::-1], w["ub"], tape_b, gs[:, ::-1, self.hidden :])
        return grads

    def fit(self, chars: np.ndarray, gold: np.ndarray, steps: int = 400, batch: int = 64, rate: float = 0.02) -> None:
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        for n in range(1, steps + 1):
            rows = self.rng.integers(0, len(chars), batch)
            grads = self._gradients(chars[rows], gold[rows])
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
            now = rate * min(1.0, 2.5 * (1 - n / (steps + 1)))
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / (norm + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                self.w[k] -= now * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.99**n)) + 1e-6)

    def decode(self, emissions: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Best tags of padded rows of emissions; tags behind a row's size are 0."""
        rows, steps, k = emissions.shape
        trans = np.where(self.barred == 0, self.w["trans"], -np.inf).astype(np.float32)
        # Rows lie along the last axis.
        line = np.ascontiguousarray(emissions.transpose(1, 2, 0))
        inside = np.arange(steps)[:, None] < sizes
        into, score = trans.T[:, :, None], np.empty_like(line)
        score[0] = line[0]
        for t in range(1, steps):
            np.max(score[t - 1] + into, axis=1, out=score[t])
            score[t] += line[t]
            np.copyto(score[t], score[t - 1], where=~inside[t])
        # The way back asks for the best tag before the one at hand, the first of equal ones.
        tags = np.zeros((steps, rows), np.int64)
        now = score[-1].argmax(axis=0)
        for t in range(steps - 1, 0, -1):
            np.copyto(tags[t], now, where=inside[t])
            np.copyto(now, (score[t - 1] + trans[:, now]).argmax(axis=0), where=inside[t])
        np.copyto(tags[0], now, where=inside[0])
        return tags.T

    def best_path(self, scores: np.ndarray, first: np.ndarray, sizes: np.ndarray, margin: float = 0.0) -> np.ndarray:
        """Best tags of rows that lie one after the other in scores (tag, place); 0 between them.

        Where even the best stretch of other tags around a character beats tag 0 by less than
        ``margin``, every best path has tag 0 or a stretch that is to be dropped. Only what lies
        between such characters is decoded step by step.
        """
        trans = self.w["trans"].astype(np.float64) + self.barred
        places = scores.shape[1]
        inside = np.zeros(places + 1, np.int64)
        np.add.at(inside, first, 1)
        np.add.at(inside, first + sizes, -1)
        inside = np.cumsum(inside[:-1]) > 0
        rest = trans[0, 0]
        within, enter, leave = trans[1:, 1:].max() - rest, trans[0, 1:].max() - rest, trans[1:, 0].max() - rest
        gain = np.where(inside, scores[1:].max(axis=0).astype(np.float64) - scores[0] + within, -1e6)
        # A stretch at a row's edge has nothing to enter from, or to leave to.
        gain[first] += max(0.0, -enter)
        gain[(first + sizes - 1)[sizes > 0]] += max(0.0, -leave)
        total = np.cumsum(gain)
        until = total - np.minimum.accumulate(np.append(0.0, total[:-1]))
        onward = np.maximum.accumulate(total[::-1])[::-1] - (total - gain)
        open_ = inside & (until + onward - gain + enter + leave - within > margin - 1e-2)
        edge = np.diff(np.concatenate([[0], open_.astype(np.int8), [0]]))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # Two rows never touch: a place outside both lies between them.
        opens, closes = np.zeros(places + 1, bool), np.zeros(places + 1, bool)
        opens[first], closes[first + sizes] = True, True
        tags, length = np.zeros(places, np.int64), end - start
        order = np.argsort(length, kind="stable")
        while len(order):
            longest = int(length[order[-1]])
            part = order[length[order] * 2 > longest][-max(1, 65536 // longest) :]
            order = order[: len(order) - len(part)]
            at = start[part, None] + np.arange(longest)
            own = scores[:, np.minimum(at, places - 1)].transpose(1, 2, 0)
            rows = np.arange(len(part))
            own[:, 0] += np.where(opens[start[part]][:, None], 0, trans[0])
            own[rows, length[part] - 1] += np.where(closes[end[part]][:, None], 0, trans[:, 0])
            mine = np.arange(longest) < length[part, None]
            tags[at[mine]] = self.decode(own, length[part])[mine]
        return tags
