"""Five-word shingle sets as 64-bit hashes, and SetSketch registers over them (numpy, per document)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from pulsekit.llm.common import coded, words_of

SHINGLE_WORDS = 5

# SetSketch parameters: M registers with base B, rate A and truncation at 0 and Q + 1. With this B two registers are
# equal with a probability that is close to the Jaccard similarity.
M = 256
B = 1.001
A = 20.0
Q = 65534

_ODD = np.random.default_rng(20240501).integers(0, 2**63, size=(2, M + SHINGLE_WORDS + 1), dtype=np.uint64) * 2 + 1
_FLIP, _MULT = _ODD[0, :M], _ODD[1, :M]
_POWER, _LENGTH_SALT = _ODD[0, M:M + SHINGLE_WORDS], _ODD[1, M:]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Per text the sorted distinct shingle hashes; a text of fewer than five words is one shingle, none is empty.

    The hash is of 64 bits over whole words, so that two different shingles of one pair of documents meet with a
    probability below (set size)**2 / 2**64.
    """
    flat, offsets = words_of(texts, lower=True)
    distinct, codes = coded(flat)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    words = hashes[codes]
    n = len(words) - SHINGLE_WORDS + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(SHINGLE_WORDS):
        rolled += words[k:k + len(rolled)] * _POWER[k]
    rolled = mix(rolled ^ _LENGTH_SALT[SHINGLE_WORDS])
    sets = []
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if hi - lo >= SHINGLE_WORDS:
            sets.append(np.unique(rolled[lo:hi - SHINGLE_WORDS + 1]))
        elif hi > lo:
            one = np.uint64((words[lo:hi] * _POWER[:hi - lo]).sum(dtype=np.uint64)) ^ _LENGTH_SALT[hi - lo]
            sets.append(mix(np.array([one], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def registers(shingles: np.ndarray, chunk: int = 4096) -> np.ndarray:
    """SetSketch registers of a set: truncated, exponentially spaced minima of M exponential hash values.

    ``K_i = clip(floor(1 - log_B(min_d x_i(d))), 0, Q + 1)`` with ``x_i(d) ~ Exp(A)``. The exponential is a monotone
    function of a uniform hash, so the minimum is taken on hashes and turned into an exponential once per register.
    Registers of a union are the element-wise maxima of the parts' registers.
    """
    least = np.full(M, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), chunk):
        part = (shingles[None, i:i + chunk] ^ _FLIP[:, None]) * _MULT[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    x = -np.log1p(-((least >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / A
    return np.clip(np.floor(1 - np.log(x) / np.log(B)), 0, Q + 1).astype(np.uint16)


def _advance(x: np.ndarray) -> np.ndarray:
    """p_B(x) = -log_B(1 - x (B - 1) / B)."""
    return -np.log1p(-x * (B - 1) / B) / np.log(B)


def joint_estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs, from registers (pairs x M) and the known set sizes.

    The counts of larger, smaller and equal registers are multinomial with probabilities p_B(u - v J), p_B(v - u J)
    and the rest, with u and v the sets' shares of the summed sizes. The log-likelihood is concave in J, so a bisection
    of its derivative's sign finds the maximum.
    """
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u = size_a / (size_a + size_b)
    v = 1 - u
    top = np.minimum(u / v, v / u)

    def loglik(j):
        p, q = _advance(np.maximum(u - v * j, 0)), _advance(np.maximum(v - u * j, 0))
        tiny = 1e-300
        return (more * np.log(np.maximum(p, tiny)) + less * np.log(np.maximum(q, tiny))
                + same * np.log(np.maximum(1 - p - q, tiny)))

    lo, hi = np.zeros_like(top), top.copy()
    for _ in range(30):
        third = (hi - lo) / 3
        left, right = lo + third, hi - third
        rising = loglik(left) < loglik(right)
        lo, hi = np.where(rising, left, lo), np.where(rising, hi, right)
    return (lo + hi) / 2
