"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Inputs are character classes (one of 128 ASCII characters, a letter beyond, anything else), so the input layer
is a table. All windows of a batch move one character per step, both directions at once. Trained by
gradient descent (Adam) on the log-likelihood of whole label paths. Label 0 is "nothing".
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LETTER, OTHER, PAD = 128, 129, 130
CLASSES = 131
_F = np.float32

_TABLE = np.full(65536, OTHER, np.uint8)
_TABLE[:128] = np.arange(128)
_TABLE[[c for c in range(128, 65536) if chr(c).isalpha()]] = LETTER


def encode(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _TABLE[np.minimum(points, 65535)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(np.minimum(x, 60, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@dataclass
class Tagger:
    """Weights: ``table`` (2, classes, 4H), ``inner`` (2, H, 4H), ``out`` (2, H, K), ``bias`` (K), ``moves`` (K, K).

    Gates lie as input, forget, output, candidate. Direction 1 reads from the end.
    """

    table: np.ndarray
    inner: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    moves: np.ndarray

    @classmethod
    def new(cls, labels: int, hidden: int, seed: int) -> Tagger:
        draw = np.random.default_rng(seed)
        table = draw.normal(0, 0.3, (2, CLASSES, 4 * hidden))
        table[:, :, hidden : 2 * hidden] += 1
        inner = draw.normal(0, hidden**-0.5, (2, hidden, 4 * hidden))
        out = draw.normal(0, hidden**-0.5, (2, hidden, labels))
        return cls(*(a.astype(_F) for a in (table, inner, out, np.zeros(labels), np.zeros((labels, labels)))))

    def weights(self) -> list[np.ndarray]:
        return [self.table, self.inner, self.out, self.bias, self.moves]

    def emissions(self, x: np.ndarray, keep: list) -> np.ndarray:
        """(steps, batch, labels) for classes ``x`` (batch, steps); ``keep`` gets what the gradient needs."""
        batch, steps = x.shape
        hidden = self.inner.shape[1]
        h, c = np.zeros((2, batch, hidden), _F), np.zeros((2, batch, hidden), _F)
        scores = np.zeros((steps, batch, len(self.bias)), _F)
        for t in range(steps):
            at = (t, steps - 1 - t)
            z = np.matmul(h, self.inner) + np.stack([self.table[side][x[:, at[side]]] for side in (0, 1)])
            z[:, :, : 3 * hidden] = _sigmoid(z[:, :, : 3 * hidden])
            z[:, :, 3 * hidden :] = np.tanh(z[:, :, 3 * hidden :])
            gate, forget, output, candidate = (z[:, :, k * hidden : (k + 1) * hidden] for k in range(4))
            before, c = c, forget * c + gate * candidate
            squeezed = np.tanh(c)
            last, h = h, output * squeezed
            keep.append((last, before, z, squeezed, h))
        held = np.stack([k[-1] for k in keep])
        scores += held[:, 0] @ self.out[0]
        scores += held[::-1, 1] @ self.out[1]
        return scores + self.bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        """``emissions`` for many windows at once: gates by rows, one exponential each, nothing kept."""
        batch, steps = x.shape
        hidden = self.inner.shape[1]
        # exp(-z) for the gates, exp(-2z) for the candidate: tanh(z) = 2 sigmoid(2z) - 1
        scale = np.repeat(np.array([-1, -1, -1, -2], _F), hidden)
        table = np.ascontiguousarray(self.table * scale)
        inner = np.ascontiguousarray((self.inner * scale).transpose(0, 2, 1))
        columns = np.ascontiguousarray(x.T).astype(np.intp)
        held = np.empty((2, steps, hidden, batch), _F)
        h, c = np.zeros((2, hidden, batch), _F), np.zeros((2, hidden, batch), _F)
        z, mixed = np.empty((2, 4 * hidden, batch), _F), np.empty((2, hidden, batch), _F)
        looked_up = np.empty((batch, 4 * hidden), _F)
        gate, forget, output, candidate = (z[:, k * hidden : (k + 1) * hidden] for k in range(4))
        with np.errstate(over="ignore"):
            for t in range(steps):
                np.matmul(inner, h, out=z)
                for side, at in enumerate((t, steps - 1 - t)):
                    np.take(table[side], columns[at], axis=0, out=looked_up, mode="clip")
                    z[side] += looked_up.T
                np.exp(z, out=z)
                z += 1
                np.reciprocal(z, out=z)
                candidate *= 2
                candidate -= 1
                c *= forget
                np.multiply(gate, candidate, out=mixed)
                c += mixed
                np.multiply(c, -2, out=mixed)
                np.exp(mixed, out=mixed)
                mixed += 1
                np.divide(2, mixed, out=mixed)
                mixed -= 1
                np.multiply(output, mixed, out=h)
                held[0, t], held[1, steps - 1 - t] = h[0], h[1]
        out = self.out.transpose(0, 2, 1)
        found = np.matmul(out[0], held[0])
        found += np.matmul(out[1], held[1])
        found += self.bias[:, None]
        return found

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """The best label path of each window of ``scores`` (steps, labels, batch): (batch, steps), by Viterbi.

        A window in which no character's label can gain on "nothing", even with the best transition in and
        out, has nothing in it and needs no search.
        """
        steps, labels, batch = scores.shape
        path = np.zeros((batch, steps), np.uint8)
        gain = 2 * float(self.moves.max() - self.moves[0, 0])
        most = scores[:, 1:].max(axis=1)
        most -= scores[:, 0]
        some = np.nonzero(most.max(axis=0) > -gain)[0]
        if not len(some):
            return path
        scores = scores[:, :, some].transpose(0, 2, 1)
        best, back = scores[0], np.empty((steps, len(some), labels), np.uint8)
        for t in range(1, steps):
            options = best[:, :, None] + self.moves
            back[t] = options.argmax(axis=1)
            best = options.max(axis=1) + scores[t]
        label = best.argmax(axis=1)
        row = np.arange(len(some))
        for t in range(steps - 1, -1, -1):
            path[some, t] = label
            if t:
                label = back[t][row, label]
        return path

    def marginals(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Label probabilities (steps, batch, labels), expected transitions, and log of the sum over paths."""
        steps = len(scores)
        ahead, behind = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0]
        for t in range(1, steps):
            ahead[t] = scores[t] + _logsumexp(ahead[t - 1][:, :, None] + self.moves, 1)
        for t in range(steps - 2, -1, -1):
            behind[t] = _logsumexp(self.moves + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
        total = _logsumexp(ahead[-1], 1)
        moved = np.zeros_like(self.moves)
        for t in range(1, steps):
            pair = ahead[t - 1][:, :, None] + self.moves + (scores[t] + behind[t])[:, None, :]
            moved += np.exp(pair - total[:, None, None]).sum(axis=0)
        return np.exp(ahead + behind - total[:, None]), moved, total

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log-likelihood of paths ``y`` (batch, steps), and its gradient by each weight."""
        keep: list = []
        batch, steps = x.shape
        hidden = self.inner.shape[1]
        scores = self.emissions(x, keep)
        share, moved, total = self.marginals(scores)
        row, col = np.indices(y.T.shape)
        right = scores[row, col, y.T].sum(axis=0) + self.moves[y[:, :-1], y[:, 1:]].sum(axis=1)
        share[row, col, y.T] -= 1
        np.subtract.at(moved, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        d_scores = share / batch
        flat = lambda a: a.reshape(-1, a.shape[-1])
        both = (d_scores, d_scores[::-1])  # as each direction meets them
        d_out = np.stack([flat(np.stack([k[-1][side] for k in keep])).T @ flat(both[side]) for side in (0, 1)])
        from_scores = np.stack([both[side] @ self.out[side].T for side in (0, 1)], axis=1)
        d_table = np.zeros_like(self.table)
        d_h, d_c = np.zeros((2, batch, hidden), _F), np.zeros((2, batch, hidden), _F)
        d_gates = np.empty((2, steps, batch, 4 * hidden), _F)
        for t in range(steps - 1, -1, -1):
            _, before, z, squeezed, _ = keep[t]
            d_h = d_h + from_scores[t]
            gate, forget, output, candidate = (z[:, :, k * hidden : (k + 1) * hidden] for k in range(4))
            d_c = d_c + d_h * output * (1 - squeezed**2)
            d_z = np.concatenate(
                [
                    d_c * candidate * gate * (1 - gate),
                    d_c * before * forget * (1 - forget),
                    d_h * squeezed * output * (1 - output),
                    d_c * gate * (1 - candidate**2),
                ],
                axis=2,
            )
            d_gates[:, t] = d_z
            d_h = np.matmul(d_z, self.inner.transpose(0, 2, 1))
            d_c = d_c * forget
        before = np.stack([k[0] for k in keep], axis=1)
        d_inner = np.stack([flat(before[side]).T @ flat(d_gates[side]) for side in (0, 1)])
        for side, columns in enumerate((x.T, x.T[::-1])):
            classes = columns.ravel()
            order = np.argsort(classes, kind="stable")
            first = np.nonzero(np.diff(classes[order].astype(np.int64), prepend=-1))[0]
            d_table[side][classes[order[first]]] = np.add.reduceat(flat(d_gates[side])[order], first, axis=0)
        loss = float((total - right).mean())
        return loss, [d_table, d_inner, d_out, d_scores.sum(axis=(0, 1)), moved / batch]

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int, batch: int, rate: float, seed: int) -> list[float]:
        """Adam over shuffled batches; returns the mean loss of each round."""
        draw = np.random.default_rng(seed)
        means, squares = ([np.zeros_like(w) for w in self.weights()] for _ in range(2))
        step, losses = 0, []
        n_steps = rounds * -(-len(x) // batch)
        for _ in range(rounds):
            order, total = draw.permutation(len(x)), 0.0
            for start in range(0, len(x), batch):
                picked = order[start : start + batch]
                loss, slopes = self.gradients(x[picked], y[picked])
                total += loss * len(picked)
                step += 1
                norm = np.sqrt(sum(float((g**2).sum()) for g in slopes))
                now = rate * (1 - step / (n_steps + 1))
                for w, g, m, s in zip(self.weights(), slopes, means, squares):
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    m += 0.1 * (g - m)
                    s += 0.01 * (g * g - s)
                    w -= (now * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)).astype(_F)
            losses.append(total / len(x))
        return losses
