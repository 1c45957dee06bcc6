"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Characters index rows of the input weights (the embedding times the input matrix, learned as one table).  All functions
work on a batch of windows of one length.
"""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
PAD, OTHER, NEWLINE = 0, 1, 2
CHARACTERS = 3 + 95
HIDDEN = 24
_FORBIDDEN = -1e4


def character_codes(points: np.ndarray) -> np.ndarray:
    """Codes of code points: printable ASCII each, new line, anything else."""
    out = np.full(len(points), OTHER, np.int64)
    out[points == 10] = NEWLINE
    printable = (points >= 32) & (points < 127)
    out[printable] = points[printable].astype(np.int64) - 32 + 3
    return out


def tag_rules() -> tuple[np.ndarray, np.ndarray]:
    """Penalties of transitions and of first tags that no labelling has: inside without its begin."""
    between, first = np.zeros((TAGS, TAGS)), np.zeros(TAGS)
    for k in range(len(KINDS)):
        begin, inside = 1 + 2 * k, 2 + 2 * k
        between[:, inside] = _FORBIDDEN
        between[begin, inside] = between[inside, inside] = 0
        first[inside] = _FORBIDDEN
    return between, first


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Tagger:
    def __init__(self, seed: int = 7, hidden: int = HIDDEN):
        draw = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {}
        for side in ("f", "b"):
            self.p[f"in_{side}"] = draw.normal(0, 0.3, (CHARACTERS, 4 * hidden))
            self.p[f"in_{side}"][:, hidden : 2 * hidden] += 1.0  # the forget gate starts open
            self.p[f"rec_{side}"] = draw.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
        self.p["out"] = draw.normal(0, 0.2, (2 * hidden, TAGS))
        self.p["bias"] = np.zeros(TAGS)
        self.p["trans"], self.p["first"] = np.zeros((TAGS, TAGS)), np.zeros(TAGS)
        self.between, self.start = tag_rules()

    def _lstm(self, side: str, codes: np.ndarray, back: bool = True):
        """States (time x batch x hidden) and, with ``back``, what the way back needs."""
        table, rec, h = self.p[f"in_{side}"], self.p[f"rec_{side}"], self.hidden
        steps = codes.T
        state, cell = (np.zeros((codes.shape[0], h)) for _ in range(2))
        states, kept = [], []
        for c in steps:
            z = table[c] + state @ rec
            gate = _sigmoid(z[:, : 3 * h])
            i, f, o, g = gate[:, :h], gate[:, h : 2 * h], gate[:, 2 * h :], np.tanh(z[:, 3 * h :])
            before, old = cell, state
            cell = f * cell + i * g
            t = np.tanh(cell)
            state = o * t
            states.append(state)
            if back:
                kept.append((c, i, f, o, g, before, t, old))
        return np.stack(states), kept

    def _lstm_back(self, side: str, kept, grads: np.ndarray, out: dict) -> None:
        table, rec, h = self.p[f"in_{side}"], self.p[f"rec_{side}"], self.hidden
        d_table, d_rec = np.zeros_like(table), np.zeros_like(rec)
        d_state = d_cell = np.zeros_like(grads[0])
        for t in range(len(kept) - 1, -1, -1):
            c, i, f, o, g, before, tc, old = kept[t]
            d = grads[t] + d_state
            d_cell = d_cell + d * o * (1 - tc * tc)
            dz = np.concatenate([d_cell * g * i * (1 - i), d_cell * before * f * (1 - f), d * tc * o * (1 - o), d_cell * i * (1 - g * g)], 1)
            np.add.at(d_table, c, dz)
            d_rec += old.T @ dz
            d_state, d_cell = dz @ rec.T, d_cell * f
        out[f"in_{side}"], out[f"rec_{side}"] = d_table, d_rec

    def emissions(self, codes: np.ndarray, back: bool = True):
        """Tag scores (time x batch x tags) of a batch of windows (batch x time)."""
        forward, kept_f = self._lstm("f", codes, back)
        backward, kept_b = self._lstm("b", codes[:, ::-1], back)
        both = np.concatenate([forward, backward[::-1]], 2)
        return both @ self.p["out"] + self.p["bias"], (both, kept_f, kept_b)

    def loss(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood per window of the CRF, and its gradients."""
        scores, (both, kept_f, kept_b) = self.emissions(codes)
        time, batch, _ = scores.shape
        trans, first = self.p["trans"] + self.between, self.p["first"] + self.start
        alpha, beta = np.empty_like(scores), np.zeros_like(scores)
        alpha[0] = scores[0] + first

        def total(x, axis):
            top = x.max(axis, keepdims=True)
            return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)

        for t in range(1, time):
            alpha[t] = scores[t] + total(alpha[t - 1][:, :, None] + trans[None], 1)
        for t in range(time - 2, -1, -1):
            beta[t] = total(trans[None] + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        norm = total(alpha[-1], 1)
        share = np.exp(alpha + beta - norm[None, :, None])  # of each tag at each place
        gold, rows = tags.T, np.arange(batch)
        value = norm - scores[np.arange(time)[:, None], rows[None], gold].sum(0) - first[gold[0]] - trans[gold[:-1], gold[1:]].sum(0)
        d_scores = share.copy()
        d_scores[np.arange(time)[:, None], rows[None], gold] -= 1
        d_trans = np.zeros_like(trans)
        for t in range(1, time):
            pair = alpha[t - 1][:, :, None] + trans[None] + (scores[t] + beta[t])[:, None, :] - norm[:, None, None]
            d_trans += np.exp(pair).sum(0)
        np.add.at(d_trans, (gold[:-1].ravel(), gold[1:].ravel()), -1)
        out = {"trans": d_trans / batch, "first": d_scores[0].sum(0) / batch}
        d_scores /= batch
        out["out"] = np.tensordot(both, d_scores, ([0, 1], [0, 1]))
        out["bias"] = d_scores.sum((0, 1))
        d_both = d_scores @ self.p["out"].T
        self._lstm_back("f", kept_f, d_both[:, :, : self.hidden], out)
        self._lstm_back("b", kept_b, d_both[::-1, :, self.hidden :], out)
        return float(value.mean()), out

    def fit(self, codes: np.ndarray, tags: np.ndarray, updates: int = 150, batch: int = 64, rate: float = 0.01, seed: int = 3) -> list[float]:
        """Adam over shuffled batches, so many whatever the number of windows; the mean loss of each round."""
        draw, moments, step, losses = np.random.default_rng(seed), {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}, 0, []
        while step < updates:
            order, seen = draw.permutation(len(codes)), []
            for at in range(0, len(order), batch):
                if step == updates:
                    break
                value, grads = self.loss(codes[order[at : at + batch]], tags[order[at : at + batch]])
                seen.append(value)
                step += 1
                size = np.sqrt(sum((g * g).sum() for g in grads.values()))
                for k, g in grads.items():
                    m, v = moments[k]
                    g = g * min(1.0, 5.0 / (size + 1e-12))
                    m[:] = 0.9 * m + 0.1 * g
                    v[:] = 0.999 * v + 0.001 * g * g
                    now = rate * (0.5 if step > updates * 2 / 3 else 1.0)
                    self.p[k] -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            losses.append(float(np.mean(seen)))
        return losses

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Best tags (batch x time) under the emissions and the transitions."""
        return self._best(self.emissions(codes, back=False)[0])

    def spans(self, codes: np.ndarray) -> list[tuple[int, str, int, int, float]]:
        """(window, kind, start, end, margin) of every span in the best tags; the margin is what the score of the tags
        loses if the span's places are outside instead.
        """
        scores, _ = self.emissions(codes, back=False)
        tags = self._best(scores)
        trans, first = self.p["trans"] + self.between, self.p["first"] + self.start
        out = []
        for row, kind, start, end in window_spans(tags):
            own = tags[row, start:end]
            margin = (scores[np.arange(start, end), row, own] - scores[start:end, row, 0]).sum()
            margin += trans[own[:-1], own[1:]].sum() - trans[0, 0] * (end - start - 1)
            if start:
                margin += trans[tags[row, start - 1], own[0]] - trans[tags[row, start - 1], 0]
            else:
                margin += first[own[0]] - first[0]
            if end < tags.shape[1]:
                margin += trans[own[-1], tags[row, end]] - trans[0, tags[row, end]]
            out.append((row, kind, start, end, float(margin)))
        return out

    def _best(self, scores: np.ndarray) -> np.ndarray:
        trans = self.p["trans"] + self.between
        best, back = scores[0] + self.p["first"] + self.start, []
        for t in range(1, len(scores)):
            options = best[:, :, None] + trans[None]
            back.append(options.argmax(1))
            best = options.max(1) + scores[t]
        tags = [best.argmax(1)]
        rows = np.arange(scores.shape[1])
        for pointer in reversed(back):
            tags.append(pointer[rows, tags[-1]])
        return np.stack(tags[::-1], 1)


def window_spans(tags: np.ndarray) -> list[tuple[int, str, int, int]]:
    """(window, kind, start, end) of every span in decoded windows."""
    out = []
    for k, kind in enumerate(KINDS):
        begin, inside = tags == 1 + 2 * k, tags == 2 + 2 * k
        for row, start in zip(*np.nonzero(begin)):
            end = start + 1
            while end < tags.shape[1] and inside[row, end]:
                end += 1
            out.append((int(row), kind, int(start), int(end)))
    return out
