"""A gated recurrent language model in numpy.

Words of the vocabulary lie in classes of equal size, and a word's probability is that of its class times that inside the
class. All other words are one more class, entered as one symbol; what they get inside it is not the network's matter.
"""

from __future__ import annotations

import numpy as np

SHAPES = ("emb", "wx", "b", "wh", "wc", "bc", "wo", "bo")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def softmax(logits: np.ndarray, rows: np.ndarray, chosen: np.ndarray):
    """Log probability of the chosen column of each row, the exponentials (in place of the logits) and the inverse of their sums."""
    if max(logits.max(initial=0), -logits.min(initial=0)) > 60:
        logits -= logits.max(axis=1, keepdims=True)
    picked = logits[rows, chosen]
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    return picked - np.log(total), logits, 1 / total


def lanes_of(rows: list[np.ndarray], end: int, window: int, most: int, least: int):
    """Windows (given, targets, fresh) over all sequences laid one after another and cut into lanes of equal length.

    Every lane is full in every window; only the last window is padded, by -1. ``fresh`` marks where a sequence or a lane begins: there the state is reset.
    A sequence that runs over the end of a lane goes on in the next one, which knows the word before. There are at most ``most`` lanes, of ``least`` ids or more where there are so many.
    """
    rows = [r for r in rows if len(r)]
    ids = np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64)
    if not len(ids):
        return
    given, fresh = np.empty_like(ids), np.zeros(len(ids), bool)
    given[1:] = ids[:-1]
    begins = np.cumsum([0, *(len(r) for r in rows[:-1])])
    given[begins], fresh[begins] = end, True
    lanes = min(most, max(1, len(ids) // least))
    length = -(-len(ids) // lanes)
    fresh[::length] = True
    lanes = -(-len(ids) // length)
    filler = lanes * length - len(ids)
    given, targets = (np.concatenate([x, np.full(filler, y)]).reshape(lanes, length) for x, y in ((given, end), (ids, -1)))
    fresh = np.concatenate([fresh, np.zeros(filler, bool)]).reshape(lanes, length)
    for s in range(0, length, window):
        yield given[:, s : s + window], targets[:, s : s + window], fresh[:, s : s + window]


class Gru:
    def __init__(self, params: dict[str, np.ndarray], class_size: int):
        self.p, self.size = params, class_size
        self.hidden = params["wh"].shape[0]
        self.n_words, self.n_classes = len(params["wo"]), params["wc"].shape[1] - 1

    @classmethod
    def start(cls, counts: np.ndarray, tail: float, hidden: int, class_size: int, seed: int = 7) -> Gru:
        """Small random weights; the biases of the outputs already give the words' frequencies. ``counts`` are those of the
        vocabulary, in order of ids."""
        draw = np.random.default_rng(seed)
        n = len(counts)
        classes = -(-n // class_size)
        padded = np.zeros(classes * class_size)
        padded[:n] = counts
        mass = np.array([*padded.reshape(classes, class_size).sum(axis=1), tail]) + 0.5
        small = lambda *shape: draw.normal(0, 0.1, shape).astype(np.float32)
        bo = np.where(np.arange(len(padded)) < n, np.log(padded + 0.5), -30)
        return cls(
            {
                "emb": small(classes * class_size + 1, hidden), "wx": small(hidden, 3 * hidden), "b": np.zeros(3 * hidden, np.float32), "wh": small(hidden, 3 * hidden),
                "wc": small(hidden, classes + 1), "bc": np.log(mass / mass.sum()).astype(np.float32), "wo": small(classes * class_size, hidden), "bo": bo.astype(np.float32),
            },
            class_size,
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in SHAPES])

    def with_flat(self, flat: np.ndarray) -> Gru:
        out, at = {}, 0
        for k in SHAPES:
            out[k] = np.asarray(flat[at : at + self.p[k].size], np.float32).reshape(self.p[k].shape)
            at += self.p[k].size
        return Gru(out, self.size)

    def inputs(self) -> np.ndarray:
        """What each id adds to the gates."""
        return self.p["emb"] @ self.p["wx"] + self.p["b"]

    def step(self, gates: np.ndarray, h: np.ndarray):
        """One step in its plain form, a row for each sequence; ``advance`` does the same with a column for each."""
        n = self.hidden
        back = h @ self.p["wh"]
        both = sigmoid(gates[:, : 2 * n] + back[:, : 2 * n])
        z, r = both[:, :n], both[:, n:]
        new = np.tanh(gates[:, 2 * n :] + r * back[:, 2 * n :])
        return new + z * (h - new), z, r, new, back[:, 2 * n :]

    def advance(self, gates: np.ndarray, h: np.ndarray, gate: np.ndarray, back: np.ndarray, new: np.ndarray, state: np.ndarray) -> None:
        """The next state of all columns, into ``state``; the gates z and r, what came back and the candidate are kept for the gradients."""
        n = self.hidden
        own = self.p["wh"].T @ h
        # sigmoid(x) = 1 / (1 + exp(-x)) and tanh(x) = 1 - 2 / (1 + exp(2 x)): exp is the faster function.
        np.add(gates[: 2 * n], own[: 2 * n], out=gate)
        gate *= -1  # not np.negative, which errs in place on strided columns (numpy 2.3.5)
        np.minimum(gate, 40, out=gate)
        np.exp(gate, out=gate)
        gate += 1
        np.reciprocal(gate, out=gate)
        back[:] = own[2 * n :]
        np.multiply(gate[n:], back, out=new)
        new += gates[2 * n :]
        new += new
        np.minimum(new, 40, out=new)
        np.exp(new, out=new)
        new += 1
        np.divide(-2, new, out=new)
        new += 1
        np.subtract(h, new, out=state)
        state *= gate[:n]
        state += new

    def log_probability(self, h: np.ndarray, targets: np.ndarray, gradients: dict | None = None):
        """Natural logs of the targets' probabilities (of the class alone for words outside the vocabulary); with
        ``gradients``, adds to them and returns the gradient of -sum(log p) in h as well.

        Rows are sorted by class, so that each class is one product; all that lies between the products runs over all rows."""
        classes = np.minimum(targets // self.size, self.n_classes).astype(np.uint16)
        rows = np.arange(len(h))
        logits = h @ self.p["wc"]
        logits += self.p["bc"]
        out, e, total = softmax(logits, rows, classes)
        if gradients is not None:
            d = np.multiply(e, total[:, None], out=e)
            d[rows, classes] -= 1
            gradients["wc"] += h.T @ d
            gradients["bc"] += np.ones(len(d), d.dtype) @ d
            dh = d @ self.p["wc"].T
        order = np.argsort(classes, kind="stable")
        edges = np.searchsorted(classes[order], np.arange(self.n_classes + 1))
        order = order[: edges[-1]]
        if len(order):
            present = [(c, edges[c], edges[c + 1]) for c in range(self.n_classes) if edges[c] < edges[c + 1]]
            ones = np.ones((len(order), 1), h.dtype)
            own = np.concatenate([h[order], ones], axis=1)
            words = np.concatenate([self.p["wo"], self.p["bo"][:, None]], axis=1).reshape(self.n_classes, self.size, -1)
            logits = np.empty((len(order), self.size), np.result_type(own, words))
            for c, a, b in present:
                np.matmul(own[a:b], words[c].T, out=logits[a:b])
            rows, inside = rows[: len(order)], targets[order] % self.size
            found, e, total = softmax(logits, rows, inside)
            out[order] += found
            if gradients is not None:
                d = np.multiply(e, total[:, None], out=e)
                d[rows, inside] -= 1
                to_words, to_h = np.zeros_like(words), np.empty_like(own)
                for c, a, b in present:
                    np.matmul(d[a:b].T, own[a:b], out=to_words[c])
                    np.matmul(d[a:b], words[c], out=to_h[a:b])
                to_words = to_words.reshape(-1, self.hidden + 1)
                gradients["wo"] += to_words[:, :-1]
                gradients["bo"] += to_words[:, -1]
                dh[order] += to_h[:, :-1]
        return out if gradients is None else (out, dh)

    def score(self, texts: list[np.ndarray], end: int, window: int = 64, together: int = 1024) -> np.ndarray:
        """The log probability of each whole id sequence, the end id being the first input. Sequences run side by side,
        longest first; each keeps its state from window to window until it ends. Windows grow as fewer sequences go on."""
        result = np.zeros(len(texts))
        order = np.argsort([-len(t) for t in texts], kind="stable")
        inputs = np.ascontiguousarray(self.inputs().T)
        for s in range(0, len(order), together):
            group = order[s : s + together]
            lengths = np.array([len(texts[i]) for i in group])
            n = self.hidden
            h = np.zeros((n, len(group)), np.float32)
            room = [np.empty((k, len(group)), np.float32) for k in (2 * n, n, n, n)]
            last = np.full(len(group), end)
            start, longest = 0, int(lengths[0])
            while start < longest:
                live = int((lengths > start).sum())
                width = min(max(window // 4, window * 256 // live), 16 * window, longest - start)
                ids = np.full((live, width), end)
                for k in range(live):
                    part = texts[group[k]][start : start + width]
                    ids[k, : len(part)] = part
                given = np.concatenate([last[:live, None], ids[:, :-1]], axis=1).T
                gates = np.take(inputs, given.ravel(), axis=1).reshape(-1, width, live)
                counts = live - np.searchsorted(np.sort(lengths[:live]), start + np.arange(width), side="right")
                edges = np.concatenate([[0], np.cumsum(counts)])
                states = np.empty((n, edges[-1]), np.float32)
                for t, m in enumerate(counts):
                    *kept, state = (x[:, :m] for x in room)
                    self.advance(gates[:, t, :m], h[:, :m], *kept, state)
                    h[:, :m] = state
                    states[:, edges[t] : edges[t + 1]] = state
                found = self.log_probability(np.ascontiguousarray(states.T), np.concatenate([ids[:m, t] for t, m in enumerate(counts)]))
                owner = np.concatenate([group[:m] for m in counts])
                result += np.bincount(owner, weights=found, minlength=len(texts))
                last[:live] = ids[:, -1]
                start += width
        return result

    def train(self, batches, end: int, window: int = 16, rate: float = 0.01, lanes: int = 256, lane: int = 1024) -> int:
        """One pass of truncated backpropagation with Adam over batches of id sequences. Sequences fill lanes one after another (``lanes_of``);
        the state is carried from window to window and reset where a sequence begins, gradients stay in their window. Returns the number of tokens met."""
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        seen = turn = 0
        for rows in batches:
            h = None
            for given, targets, fresh in lanes_of(rows, end, window, lanes, lane):
                h = np.zeros((len(given), self.hidden), np.float32) if h is None else h
                gradients, h, n = self.window_gradients(given, targets, h, fresh)
                if not n:
                    continue
                seen += n
                turn += 1
                norm = np.sqrt(sum(float((g**2).sum()) for g in gradients.values())) / n
                scale = np.float32(min(1.0, 1.0 / max(norm, 1e-9)) / n)
                for k, g in gradients.items():
                    g *= scale
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    step = rate * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-6)
                    self.p[k] -= step.astype(np.float32)
        return seen

    def window_gradients(self, given: np.ndarray, targets: np.ndarray, h: np.ndarray, fresh: np.ndarray | None = None):
        """Gradients of one window for -sum(log p) of its targets (-1: none), the state after it, and the tokens met. Where
        ``fresh`` holds, a row's state is reset before the word, and no gradient passes."""
        n, wh = self.hidden, self.p["wh"]
        given, targets = np.where(given < 0, 0, given).T, targets.T
        width, rows = given.shape
        ids = given.ravel().astype(np.uint16 if len(self.p["emb"]) < 1 << 16 else np.int64)
        resets = [None if fresh is None or not fresh[:, t].any() else fresh[:, t] for t in range(width)]
        # A column for each row and word: products and gates run over whole lanes.
        gates = np.take(np.ascontiguousarray(self.inputs().T), ids, axis=1).reshape(3 * n, width, rows)
        both = np.empty((2 * n, width, rows), gates.dtype)
        before, new, back, states = (np.empty((n, width, rows), gates.dtype) for _ in range(4))
        last = h.T
        for t in range(width):
            before[:, t] = last
            if resets[t] is not None:
                before[:, t, resets[t]] = 0
            self.advance(gates[:, t], before[:, t], both[:, t], back[:, t], new[:, t], states[:, t])
            last = states[:, t]
        gradients = {k: np.zeros_like(v) for k, v in self.p.items()}
        held = targets.ravel() >= 0
        flat = np.ascontiguousarray(states.reshape(n, -1).T)
        if held.all():
            d_states = self.log_probability(flat, targets.ravel(), gradients)[1]
        else:
            d_states = np.zeros_like(flat)
            d_states[held] = self.log_probability(flat[held], targets.ravel()[held], gradients)[1]
        d_states = np.ascontiguousarray(d_states.T).reshape(states.shape)
        z, r = both[:n], both[n:]
        to_new, to_z, to_r = (1 - z) * (1 - new * new), (before - new) * (z * (1 - z)), back * (r * (1 - r))
        d_back, d_new = np.empty_like(gates), np.empty_like(new)
        carry = np.zeros_like(last)
        for t in range(width - 1, -1, -1):
            dh = d_states[:, t]
            dh += carry
            np.multiply(dh, to_new[:, t], out=d_new[:, t])
            np.multiply(dh, to_z[:, t], out=d_back[:n, t])
            np.multiply(d_new[:, t], to_r[:, t], out=d_back[n : 2 * n, t])
            np.multiply(d_new[:, t], r[:, t], out=d_back[2 * n :, t])
            carry = wh @ d_back[:, t]
            dh *= z[:, t]
            carry += dh
            if resets[t] is not None:
                carry[:, resets[t]] = 0
        gradients["wh"] += before.reshape(n, -1) @ d_back.reshape(3 * n, -1).T
        d_back[2 * n :] = d_new
        flat = d_back.reshape(3 * n, -1)
        gradients["b"] += flat.sum(axis=1)
        gradients["wx"] += np.take(np.ascontiguousarray(self.p["emb"].T), ids, axis=1) @ flat.T
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        begins = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        to_emb = np.take(self.p["wx"] @ flat, order, axis=1)
        gradients["emb"][ids[begins]] += np.add.reduceat(to_emb, begins, axis=1).T
        return gradients, np.ascontiguousarray(last.T), int(held.sum())
