"""Public tokenizers over parts of texts, so that what a task holds of a text's encoding is bounded.

Both tokenizer files split a text at white space before anything else, and none of their patterns spans the place
before a single space that a non-space follows. A text therefore has the ids of its chunks, in order, where chunks are
cut at these places (the space goes to the chunk after it), and those of any runs of chunks.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pulsekit.llm.common import coded, kept

#: A cut is allowed before a space that something other than white space follows. White space here is the union of
#: what Python, RE2 and the tokenizers call so: fewer cuts are always safe.
_CUT = re.compile(r" (?=[^\s\x1c-\x1f\x85])")
_NO_CUT_BEFORE = (r"^$|^[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
                  r"\x{3000}]")

#: Entries and ids that a task's cache holds at most; beyond, it starts anew.
CACHE_CHUNKS, CACHE_IDS = 1 << 18, 1 << 21
#: Chunks whose ids are joined to texts at a time (or one longer text).
JOINED_CHUNKS = 1 << 16
#: Characters after which a text that goes to the rank form is cut at the next place that allows it.
PART_CHARS = 1 << 16
#: A run of white space beyond this goes to the tokenizer: the rank form's pattern fails on runs of a million.
WHITE_CHARS = 1 << 18
_WHITE = re.compile(r"[\s\x1c-\x1f\x85]+")


def load(path: str):
    """The tokenizer of a .json file, loaded once per Python worker."""
    def make():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    return kept("tokenizers", path, make)


def load_ranks(path: str, pattern: str):
    """An encoder for the same byte-level vocabulary kept as ranks, loaded once per Python worker, and which of its ids
    begin with a space."""
    def make():
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        spaced = np.zeros(max(ranks.values()) + 1, bool)
        spaced[[rank for piece, rank in ranks.items() if piece.startswith(b" ")]] = True
        return tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), spaced

    return kept("tokenizers", path, make)


def _chunks(text: str) -> list[str]:
    """The text, cut wherever it is allowed."""
    first, *others = _CUT.split(text)
    return [first, *(" " + c for c in others)]


def _parts(text: str) -> Iterator[str]:
    """The text, cut at few of the allowed places: a part is as long as it must be and at least ``PART_CHARS``."""
    start = 0
    while len(text) - start > PART_CHARS and (cut := _CUT.search(text, start + PART_CHARS)):
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


class ChunkEncoder:
    """Ids of whole texts by way of their distinct chunks.

    The tokenizer encodes a chunk once while it is cached. ``ranks`` (path, pattern) names the same vocabulary in rank
    form, whose encoder has the same ids in less time than a call per chunk and a cache take: the distinct chunks of the
    given texts go to it as one running text. Texts with runs of white space go to it as they are, and chunks with a
    string of the tokenizer's special tokens to the tokenizer itself.
    """

    def __init__(self, path: str, ranks: tuple[str, str] | None = None):
        self.tokenizer = load(path)
        encoding, self.spaced = load_ranks(*ranks) if ranks else (None, None)
        self.fast = encoding.encode_ordinary if ranks else None
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, self.added)) if self.added else "(?!)")
        self.clear()

    def _slow(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _part(self, part: str) -> list[int]:
        """Ids of a part by the rank form, but for what only the tokenizer can encode."""
        special = self.special.search
        if len(part) > WHITE_CHARS and any(m.end() - m.start() > WHITE_CHARS for m in _WHITE.finditer(part)):
            return self._slow(part)
        if not special(part):
            return self.fast(part)
        runs = groupby(_chunks(part), lambda c: special(c) is not None)
        return [k for slow, run in runs for k in (self._slow if slow else self.fast)("".join(run))]

    def _direct(self, text: str) -> np.ndarray:
        found = [np.array(self._part(p), np.uint32) for p in _parts(text)]
        return found[0] if len(found) == 1 else np.concatenate(found)

    def _encode_once(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, of whose distinct chunks each is encoded once."""
        parts = pc.split_pattern(texts, " ")
        offsets = parts.offsets.to_numpy().astype(np.int64)
        words, codes = coded(parts.flatten())
        first = np.zeros(len(codes), bool)
        first[offsets[:-1]] = True  # splitting gives at least one word, if an empty one
        uncut = pc.match_substring_regex(words, _NO_CUT_BEFORE).to_numpy(zero_copy_only=False)
        special = np.zeros(len(words), bool)
        for content in self.added:
            special |= pc.match_substring(words, content).to_numpy(zero_copy_only=False)
        odd = np.add.reduceat(uncut[codes] & ~first | special[codes], offsets[:-1]) > 0
        plain = ~np.repeat(odd, np.diff(offsets))
        heads = np.flatnonzero(np.bincount(codes[plain & first], minlength=len(words)))
        spaced = np.flatnonzero(np.bincount(codes[plain & ~first], minlength=len(words)))
        # Row 0 is that of no ids, for the words of odd texts; then the texts' first words, and the words after a space.
        found = [self._direct(w) for w in words.take(pa.array(heads)).to_pylist()]
        lengths = [np.zeros(1, np.int64), np.fromiter(map(len, found), np.int64, len(found))]
        if len(spaced):
            listed = pa.ListArray.from_arrays(pa.array([0, len(spaced)], pa.int32()), words.take(pa.array(spaced)))
            found.append(self._direct(" " + pc.binary_join(listed, pa.scalar(" ", words.type))[0].as_py()))
            starts = np.flatnonzero(self.spaced[found[-1]])  # no other id of a chunk begins with a space than its first
            lengths.append(np.diff(starts, append=len(found[-1])))
        self.ids, self.lengths = np.concatenate([np.zeros(0, np.uint32), *found]), np.concatenate(lengths)
        self.starts = np.cumsum(self.lengths) - self.lengths
        row_of = np.zeros((2, len(words)), np.int64)
        row_of[1, heads], row_of[0, spaced] = 1 + np.arange(len(heads)), 1 + len(heads) + np.arange(len(spaced))
        out = list(self._joined(np.where(plain, row_of[first.astype(np.int8), codes], 0), offsets))
        for k in np.flatnonzero(odd).tolist():
            out[k] = self._direct(texts[k].as_py())
        return out

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids, self.used = np.zeros(4096, np.uint32), 0

    def _rows(self, chunks: list[str]) -> np.ndarray:
        """Each chunk's row in the cache, after encoding those that aren't there."""
        if len(self.index) > CACHE_CHUNKS or self.used > CACHE_IDS:
            self.clear()
        new = [c for c in chunks if c not in self.index]
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            encoded = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
            row, total = len(self.index), int(lengths.sum())
            while len(self.starts) < row + len(part):
                self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
            while len(self.ids) < self.used + total:
                self.ids = np.resize(self.ids, 2 * len(self.ids))
            self.starts[row:row + len(part)] = self.used + np.cumsum(lengths) - lengths
            self.lengths[row:row + len(part)] = lengths
            self.ids[self.used:self.used + total] = np.fromiter(chain.from_iterable(encoded), np.uint32, total)
            self.used += total
            self.index.update((c, row + k) for k, c in enumerate(part))
        return np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))

    def _joined(self, rows: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """Ids of each text, of whose chunks the rows are those between its offsets."""
        at = 0
        while at + 1 < len(offsets):  # runs of texts, so that few places of ids are held at a time
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + JOINED_CHUNKS, side="right")) - 1)
            run = rows[offsets[at]:offsets[stop]]
            lengths = self.lengths[run]
            ends = np.cumsum(lengths)
            flat = self.ids[np.repeat(self.starts[run] - ends + lengths, lengths) + np.arange(int(lengths.sum()))]
            bounds = np.concatenate([[0], ends])[offsets[at:stop + 1] - offsets[at]].tolist()
            yield from (flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True))
            at = stop

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, as uint32 arrays."""
        if self.fast is not None and len(texts):
            return self._encode_once(texts)
        parts = pc.split_pattern(texts, " ")
        offsets = parts.offsets.to_numpy().astype(np.int64)
        encoded = parts.flatten().dictionary_encode()
        distinct, codes = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.zeros(len(codes), bool)
        first[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
        joined = pc.match_substring_regex(distinct, _NO_CUT_BEFORE).to_numpy(zero_copy_only=False)[codes] & ~first
        odd = np.add.reduceat(np.append(joined, False), offsets[:-1]) > 0 if len(texts) else np.zeros(0, bool)
        words, keys = distinct.to_pylist(), codes * 2 + first
        present = np.flatnonzero(np.bincount(keys[~np.repeat(odd, np.diff(offsets))], minlength=2 * len(words)))
        row_of = np.zeros(2 * len(words), np.int64)
        row_of[present] = self._rows([words[k >> 1] if k & 1 else " " + words[k >> 1] for k in present.tolist()])
        out = list(self._joined(row_of[keys], offsets)) if len(present) else [np.zeros(0, np.uint32)] * len(texts)
        for k in np.flatnonzero(odd).tolist():  # texts with a run of white space: cut where allowed
            chunks = _chunks(texts[k].as_py())
            rows = self._rows(list(dict.fromkeys(chunks)))
            at = dict(zip(dict.fromkeys(chunks), rows.tolist(), strict=True))
            out[k] = next(self._joined(np.array([at[c] for c in chunks]), np.array([0, len(chunks)])))
        return out


def piece_counts(path: str, chunks: list[str]) -> list[int]:
    """Number of ids of each chunk."""
    tokenizer, counts = load(path), []
    for at in range(0, len(chunks), 20_000):
        counts += [len(e) for e in tokenizer.encode_batch_fast(chunks[at:at + 20_000], add_special_tokens=False)]
    return counts
