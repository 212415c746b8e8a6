"""A gated recurrent language model in numpy, with a class-factored softmax and truncated backpropagation.

Documents run on parallel lanes, one after the other; a lane's state is set to zero where a document begins and is
carried over from window to window within it. A window is ``steps`` tokens of all lanes: the recurrence goes step by
step, the softmax over all of its tokens at once, class by class.
"""

from __future__ import annotations

import heapq

import numpy as np


class Gru:
    """Parameters by name, all float32: word vectors, input and recurrent matrices, class and word outputs with biases."""

    NAMES = ("we", "wi", "wh", "bh", "wc", "bc", "wo", "bo")

    def __init__(self, counts: np.ndarray, hidden: int = 16, seed: int = 1):
        """``counts`` of the tokens in training, the most frequent first: biases start as the unigram model."""
        v = len(counts)
        self.v, self.h = v, hidden
        self.size = int(np.ceil(np.sqrt(v)))  # of a class
        self.classes = -(-v // self.size)
        rng = np.random.default_rng(seed)
        p = np.zeros(self.classes * self.size)
        p[:v] = (counts + 1) / (counts + 1).sum()
        p = p.reshape(self.classes, self.size)
        with np.errstate(divide="ignore"):
            bo = np.maximum(np.log(p / p.sum(axis=1, keepdims=True)), -1e9)  # places beyond the vocabulary: probability 0
        self.p = {
            "we": rng.normal(0, 0.3, (v, hidden)), "wi": rng.normal(0, hidden ** -0.5, (hidden, 3 * hidden)),
            "wh": rng.normal(0, hidden ** -0.5, (hidden, 3 * hidden)),
            "bh": np.zeros(hidden), "wc": np.zeros((hidden, self.classes)), "bc": np.log(p.sum(axis=1)),
            "wo": np.zeros((self.classes, hidden, self.size)), "bo": bo,
        }
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in self.NAMES])

    def load(self, flat: np.ndarray) -> Gru:
        at = 0
        for k in self.NAMES:
            n = self.p[k].size
            self.p[k] = flat[at:at + n].reshape(self.p[k].shape).astype(np.float32)
            at += n
        return self

    def forward(self, inputs: np.ndarray, fresh: np.ndarray, state: np.ndarray, keep: bool):
        """States after each step (steps, hidden, lanes). inputs, fresh: (steps, lanes); fresh lanes start from zero.

        Lanes are the last axis, so that each gate is a contiguous block.
        """
        h3 = self.h
        steps, lanes = inputs.shape
        vectors = self.p["we"].take(inputs.ravel(), axis=0).reshape(steps, lanes, h3)
        x = self.p["wi"].T @ np.ascontiguousarray(vectors.transpose(0, 2, 1))
        out = np.empty((steps, h3, lanes), np.float32)
        kept = [] if keep else None
        wh, bh = np.ascontiguousarray(self.p["wh"].T), self.p["bh"][:, None]
        held = (~fresh).astype(np.float32)
        for t in range(steps):
            prev = state * held[t]
            g = wh @ prev
            zr = g[:2 * h3] + x[t, :2 * h3]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r = zr[:h3], zr[h3:]
            inner = g[2 * h3:]
            inner += bh
            n = r * inner
            n += x[t, 2 * h3:]
            np.tanh(n, out=n)
            state = np.subtract(prev, n, out=out[t])
            state *= z
            state += n
            if keep:
                kept.append((prev, z, r, n, inner))
        return out, state, kept

    def output(self, states: np.ndarray, targets: np.ndarray, grads: dict | None = None):
        """Natural log-probabilities of targets given states (n, hidden); adds gradients of their sum, returns d states."""
        p, n = self.p, len(targets)
        klass, word = targets // self.size, targets % self.size
        # states lie in (-1, 1), so weights and biases bound the logits: far from overflow nothing need be subtracted
        safe = max(np.abs(p["wc"]).sum(axis=0).max() + p["bc"].max(), np.abs(p["wo"]).sum(axis=1).max() + p["bo"].max()) < 60
        logits = states @ p["wc"]
        logits += p["bc"]
        if not safe:
            logits -= logits.max(axis=1, keepdims=True)
        logp = logits[np.arange(n), klass]
        e = np.exp(logits, out=logits)
        total = e.sum(axis=1)
        logp -= np.log(total)
        dstates = None
        if grads is not None:
            e *= (-1 / total)[:, None]
            e[np.arange(n), klass] += 1
            grads["wc"] += states.T @ e
            grads["bc"] += e.sum(axis=0)
            dstates = e @ p["wc"].T
        # sorted by class, each class is a slice: gathered and scattered once for all classes
        order = np.argsort(klass.astype(np.int16), kind="stable")
        states, word = states[order], word[order]
        bounds = np.searchsorted(klass[order], np.arange(self.classes + 1)).tolist()
        within = np.empty(n, np.float32)
        dwithin = np.empty_like(states) if grads is not None else None
        rows = np.arange(n)
        for c in range(self.classes):
            lo, hi = bounds[c], bounds[c + 1]
            if lo == hi:
                continue
            s, w, at = states[lo:hi], word[lo:hi], rows[:hi - lo]
            inner = s @ p["wo"][c]
            inner += p["bo"][c]
            if not safe:
                inner -= inner.max(axis=1, keepdims=True)
            within[lo:hi] = inner[at, w]
            e = np.exp(inner, out=inner)
            total = e.sum(axis=1)
            within[lo:hi] -= np.log(total)
            if grads is not None:
                e *= (-1 / total)[:, None]
                e[at, w] += 1
                grads["wo"][c] += s.T @ e
                grads["bo"][c] += e.sum(axis=0)
                np.matmul(e, p["wo"][c].T, out=dwithin[lo:hi])
        logp[order] += within
        if grads is not None:
            dstates[order] += dwithin
        return logp, dstates

    def backward(self, inputs, fresh, kept, dout: np.ndarray, grads: dict) -> None:
        """Backpropagation through the window's steps; what comes from later windows is cut off."""
        h3 = self.h
        wh = self.p["wh"]
        steps, lanes = inputs.shape
        dx = np.empty((steps, 3 * h3, lanes), np.float32)
        dg = np.empty_like(dx)
        carry = np.zeros((h3, lanes), np.float32)
        held = (~fresh).astype(np.float32)
        for t in range(steps - 1, -1, -1):
            prev, z, r, n, inner = kept[t]
            dh = dout[t] + carry
            keep = dh * z
            dn = np.subtract(dh, keep, out=dx[t, 2 * h3:])  # dh (1 - z)
            dz, dr, dinner = dx[t, :h3], dx[t, h3:2 * h3], dg[t, 2 * h3:]
            np.subtract(prev, n, out=dz)
            dz *= dn
            dz *= z
            dn *= 1 - n * n
            np.multiply(dn, r, out=dinner)
            np.multiply(dinner, inner, out=dr)
            dr *= 1 - r
            dg[t, :2 * h3] = dx[t, :2 * h3]
            carry = wh @ dg[t]
            carry += keep
            carry *= held[t]
        grads["wh"] += np.matmul(np.stack([k[0] for k in kept]), dg.transpose(0, 2, 1)).sum(axis=0)
        grads["bh"] += dg[:, 2 * h3:].sum(axis=(0, 2))
        tokens = inputs.ravel()
        vectors = self.p["we"].take(tokens, axis=0).reshape(steps, lanes, h3)
        grads["wi"] += np.matmul(vectors.transpose(0, 2, 1), dx.transpose(0, 2, 1)).sum(axis=0)
        dvectors = (self.p["wi"] @ dx).transpose(0, 2, 1).reshape(-1, h3)
        order = np.argsort(tokens.astype(np.int32), kind="stable")
        ordered = tokens[order]
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        grads["we"][ordered[starts]] += np.add.reduceat(dvectors.take(order, axis=0), starts, axis=0)


class Adam:
    def __init__(self, model: Gru, rate: float):
        self.model, self.rate, self.t = model, rate, 0
        self.m = {k: np.zeros_like(x) for k, x in model.p.items()}
        self.s = {k: np.zeros_like(x) for k, x in model.p.items()}

    def step(self, grads: dict, n: int, share: float = 1.0) -> None:
        """Ascends the log-likelihood whose gradients over n tokens these are; a share of a full window is a smaller step."""
        self.t += 1
        fix = share * (1 - 0.99**self.t) ** 0.5 / (1 - 0.9**self.t)
        for k, g in grads.items():
            g = g / n
            self.m[k] += 0.1 * (g - self.m[k])
            self.s[k] += 0.01 * (g * g - self.s[k])
            self.model.p[k] += (self.rate * fix) * self.m[k] / (np.sqrt(self.s[k]) + 1e-7)


def lanes_of(lengths: np.ndarray, lanes: int) -> list[list[int]]:
    """Documents of each lane, the longest first, each to the lane with the least tokens so far."""
    heap = [(0, k) for k in range(max(1, min(lanes, len(lengths))))]
    out: list[list[int]] = [[] for _ in heap]
    for d in np.argsort(-lengths, kind="stable").tolist():
        load, k = heapq.heappop(heap)
        out[k].append(d)
        heapq.heappush(heap, (load + int(lengths[d]), k))
    return out


#: Steps for which all lanes are laid out at once.
STRETCH = 1024


def windows(docs: list[np.ndarray], end_id: int, lanes: int, steps: int, before: np.ndarray | None = None):
    """(inputs, targets, fresh, document numbers, whether filled) of each window over all lanes, all (steps, lanes).

    Every document ends with its end token, which is also the input before its first token unless ``before`` has others. Lanes are in order of
    length; those that are through leave, so that a long document isn't accompanied by empty lanes.
    """
    lengths = np.array([len(d) for d in docs], np.int64)
    plan = sorted(lanes_of(lengths, lanes), key=lambda lane: -int(lengths[lane].sum()))
    ends = np.array([int(lengths[lane].sum()) for lane in plan])
    streams = []
    for lane in plan:
        target = np.concatenate([docs[d] for d in lane]).astype(np.int32)
        sizes = lengths[lane]
        begins = np.cumsum(sizes) - sizes
        inputs = np.concatenate([[end_id], target[:-1]]).astype(np.int32)
        inputs[begins] = end_id if before is None else before[lane]
        fresh = np.zeros(len(target), bool)
        fresh[begins] = True
        streams.append((inputs, target, fresh, np.repeat(lane, sizes).astype(np.int32)))
    # Lanes are laid side by side for a stretch of steps at a time, so that a long document costs its own length only.
    stretch = steps * max(1, STRETCH // steps)
    for start in range(0, int(ends[0]), stretch):
        live = int((ends > start).sum())
        width = min(stretch, int(ends[0]) - start)
        side = [np.full((width, live), fill, kind) for fill, kind in ((end_id, np.int32), (-1, np.int32), (False, bool), (0, np.int32))]
        for k in range(live):
            n = min(width, int(ends[k]) - start)
            for out, stream in zip(side, streams[k], strict=True):
                out[:n, k] = stream[start:start + n]
        for at in range(0, width, steps):
            part = slice(at, at + steps), slice(0, int((ends > start + at).sum()))
            inputs, target, fresh, owner = (x[part] for x in side)
            yield inputs, target, fresh, owner, target >= 0


def score(model: Gru, docs: list[np.ndarray], end_id: int, lanes: int = 512, steps: int = 32) -> np.ndarray:
    """Natural log-likelihood of each document."""
    sums = np.zeros(len(docs))
    state = None
    for inputs, targets, fresh, owner, filled in windows(docs, end_id, lanes, steps) if docs else ():
        state = np.zeros((model.h, inputs.shape[1]), np.float32) if state is None else state
        out, state, _ = model.forward(inputs, fresh, state[:, :inputs.shape[1]], keep=False)
        logp, _ = model.output(out.transpose(0, 2, 1)[filled], targets[filled])
        sums += np.bincount(owner[filled], weights=logp, minlength=len(docs))
    return sums


#: Tokens after which training starts a document's state anew, so that long documents go on several lanes.
TRAINED_STRETCH = 2048


def train(model: Gru, docs: list[np.ndarray], end_id: int, lanes: int, steps: int, optimizer: Adam) -> int:
    """One pass of truncated backpropagation over the documents; the number of tokens.

    Gradients are cut off at windows, the state goes on from window to window for ``TRAINED_STRETCH`` tokens.
    """
    state, seen, full = None, 0, 0
    parts = [(d[k:k + TRAINED_STRETCH], d[k - 1] if k else end_id) for d in docs for k in range(0, len(d), TRAINED_STRETCH)]
    before = np.array([b for _, b in parts], np.int32)
    for inputs, targets, fresh, _, filled in windows([d for d, _ in parts], end_id, lanes, steps, before) if parts else ():
        state = np.zeros((model.h, inputs.shape[1]), np.float32) if state is None else state
        out, state, kept = model.forward(inputs, fresh, state[:, :inputs.shape[1]], keep=True)
        grads = {k: np.zeros_like(x) for k, x in model.p.items()}
        _, d = model.output(out.transpose(0, 2, 1)[filled], targets[filled], grads)
        dout = np.zeros((*filled.shape, model.h), np.float32)
        dout[filled] = d
        dout = np.ascontiguousarray(dout.transpose(0, 2, 1))
        model.backward(inputs, fresh, kept, dout, grads)
        n = int(filled.sum())
        full = max(full, n)
        optimizer.step(grads, n, n / full)
        seen += n
    return seen
