"""Fill-in-middle: texts cut at token boundaries into prefix, middle and suffix and written in another order.

A document's boundaries go into a learned rank index (``rank_index``): the offset of a cut is predicted from its rank by
a line and corrected by the stored residual.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.llm import rank_index
from pulsekit.llm.common import BLOCK_BYTES, blocks, bounded_batches, texts_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Most that a line may miss an offset by, in code points; residuals then fit one byte.
MAX_ERROR = 120


def unit_ends(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where units ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+`` end, for a large string array without offset.

    Returns the ends of all texts' units in code points from the start of the first text, and for each text (and once
    more at the end) the number of units before it. The last unit of a text ends with the text. The bytes are read in
    pieces, so that a very long text needs little more than its units.
    """
    starts = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[:starts[-1]]
    last = np.unique(starts[1:][np.diff(starts) > 0]) - 1  # last byte of each text that has any
    ends, chars, seen = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for a in range(0, len(data), BLOCK_BYTES):
        part = data[a:a + BLOCK_BYTES + 1]
        space = (part == 32) | ((part >= 9) & (part <= 13))
        size = min(BLOCK_BYTES, len(data) - a)
        closes = ~space[:size] & np.append(space[1:], False)[:size]
        closes[last[np.searchsorted(last, a):np.searchsorted(last, a + size)] - a] = True
        points = np.cumsum((part[:size] & 0xC0) != 0x80, dtype=np.int64)
        at = np.flatnonzero(closes)
        ends.append(at + a + 1)
        chars.append(points[at] + seen)
        seen += int(points[-1])
    return np.concatenate(chars), np.searchsorted(np.concatenate(ends), starts, side="right")


def written(text: str, form: str, cut: int, end: int) -> str:
    """The text in its form, cut before code points ``cut`` and ``end``."""
    prefix, middle, suffix = text[:cut], text[cut:end], text[end:]
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}" if form == "spm" else text


def restored(output: Column, form: Column) -> Column:
    """The exact text of an output. A cut text holds no marker and no marker can arise where parts meet, so that the
    parts are what stands between the markers."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)  # an empty one comes first
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80,
                   max_error: int = MAX_ERROR) -> DataFrame:
    """Rewrites ``percent`` of the texts (doc_id, text; other columns are ignored) for fill-in-middle training.

    The choices depend on seed and doc_id alone: hashes h1 to h4 are the first 32-bit groups of the SHA-256 of
    ``seed:doc_id``. Of a text's n units the prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1), the middle
    after the larger. A text stays plain if h3 % 100 >= percent, if it is empty, or if it holds a marker; else it becomes
    suffix-prefix-middle if h4 % 100 < spm_percent and prefix-suffix-middle if not.

    Returns one row per input row: doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars (code points;
    null if plain), n_segments (lines of the rank index; null if plain), output. A null text is empty, a null doc_id
    hashes as the empty string and stays null, repeated rows are rewritten alike, and an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    hashes = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            texts = texts_of(batch)
            chars, units = unit_ends(texts)
            n = np.diff(units)
            h1, h2, h3, h4 = (batch.column(f"h{k}").to_numpy() for k in range(1, 5))
            first, second = np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))
            rows = []
            for k, value in enumerate(texts):
                text = value.as_py()
                if h3[k] % 100 >= percent or not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
                    rows.append(("plain", None, None, None, text))
                    continue
                start = chars[units[k] - 1] if units[k] else 0
                index = rank_index.fit(np.append(0, chars[units[k]:units[k + 1]] - start), max_error)
                cut, end = index.offset(int(first[k])), index.offset(int(second[k]))
                form = "spm" if h4[k] % 100 < spm_percent else "psm"
                rows.append((form, cut, end - cut, len(index.first), written(text, form, cut, end)))
            columns = [pa.array(c, t) for c, t in zip(
                zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), *columns],
                                             ["doc_id", "n", "form", "prefix_chars", "middle_chars", "n_segments", "output"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text"), *hashes).mapInArrow(
        rewrite, f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, n_segments long, output string")
