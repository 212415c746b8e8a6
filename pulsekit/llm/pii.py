"""Personal data: fixed base patterns as seeds, and contextual extraction bootstrapped from them.

1. One pass over the texts finds the base matches (the seeds) and other strings that look like an identifier (the
   candidates), each with the lexical patterns around it: two words before; one word before and one after.
2. Patterns and instances (normalised identifier strings) form a bipartite graph. Rounds of Spark joins score it: a
   pattern's confidence for a kind is the share of its distinct instances that are known to be of that kind; an
   unknown instance takes the confidence of its best pattern. Instances that reach the threshold are known in the next
   round, so that they can support further patterns, until nothing grows.
3. Occurrences of candidates in a context of high confidence are added to the base spans.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pulsekit.llm.common import blocks, fresh, materialize, texts_of

KINDS = ("email", "ip", "card", "phone")

#: A pattern needs this share of known instances, and this many of them, to extract; so does a new instance.
MIN_CONFIDENCE = 0.8
MIN_INSTANCES = 5
#: Words of a context that are longer stand in patterns as their digest.
LONG_WORD = 64
#: Most digits that an identifier has.
MOST_DIGITS = 19

# The base patterns in a form that takes linear time; runs of digits or labels can't be split in a match.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Strings that look like an identifier without being a base match.
_NUMBER = re.compile(r"[+(]?[0-9][0-9\x20().:/-]*+(?<=[0-9])|[+(]?[0-9][0-9\x20().:/-]*[0-9]")
_AT = re.compile(r"(?<!\S)[A-Za-z0-9._%+-]++(?:@|\(at\)|\[at\])[A-Za-z0-9.()\[\]-]++")
_PIECE = re.compile(r"[^\s]+")


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the email pattern: before each @ as far back as allowed, after it the longest domain."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base matches, by start and then kind as listed."""
    found = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text) if "+" in text else ():
            if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return [(s, KINDS[k], e) for s, k, e in sorted(found)]


def _kinds(string: str) -> list[str]:
    """Kinds that a string of digits and punctuation may be of."""
    digits = len(_DIGIT.findall(string))
    return (["ip"] * (string.count(".") == 3 and digits <= 12) + ["card"] * (12 <= digits <= MOST_DIGITS)
            + ["phone"] * (7 <= digits <= 15))


def _split(text: str, start: int, end: int) -> list[tuple[int, int, list[str]]]:
    """Candidates of a part of a run: the part, or, if it has too many digits for one identifier, all spans of its pieces
    between white space that haven't."""
    part = text[start:end]
    if len(_DIGIT.findall(part)) <= MOST_DIGITS:
        return [(start, end, _kinds(part))]
    pieces = [(m.start() + start, m.end() + start, len(_DIGIT.findall(m.group()))) for m in _PIECE.finditer(part)]
    found = []
    for k, (first, _, _) in enumerate(pieces):
        digits = 0
        for _, last, n in pieces[k:]:
            digits += n
            if digits > MOST_DIGITS:
                break
            if n:
                found.append((first, last, _kinds(text[first:last])))
    return found


def candidates(text: str, taken: list[tuple[int, str, int]]) -> list[tuple[int, int, list[str]]]:
    """(start, end, kinds it may be of) of strings that look like an identifier and meet no base match.

    A run of digits and punctuation that meets base matches is cut at them; see ``_split`` for the parts.
    """
    spans = sorted((s, e) for s, _, e in taken)
    out, k = [], 0
    found = [(m.start(), m.end(), ["email"]) for m in _AT.finditer(text)] if "@" in text or "at" in text else []
    found += [(m.start(), m.end(), None) for m in _NUMBER.finditer(text)]
    for start, end, kinds in sorted(found, key=lambda x: x[:2]):
        while k < len(spans) and spans[k][1] <= start:
            k += 1
        met, j = [], k
        while j < len(spans) and spans[j][0] < end:
            met.append(spans[j])
            j += 1
        if kinds:
            out += [] if any(e > start for _, e in met) else [(start, end, kinds)]
            continue
        at = start
        for s, e in [*met, (end, end)]:
            part = text[at:max(at, s)] if e > at else ""
            inner = _NUMBER.search(part)
            if inner:
                last = at + max(m.end() for m in _DIGIT.finditer(part))
                out += [x for x in _split(text, at + inner.start(), last) if x[2]]
            at = max(at, e)
    return sorted(out, key=lambda x: x[:2])


class _Words:
    """The words of a text between white space, and those beside a span."""

    def __init__(self, text: str):
        self.text = text
        self.spans = [m.span() for m in _PIECE.finditer(text)]
        self.starts, self.ends = [a for a, _ in self.spans], [b for _, b in self.spans]

    def _word(self, start: int, end: int) -> str:
        word = self.text[start:end].lower()
        return word if len(word) <= LONG_WORD else hashlib.sha256(word.encode()).hexdigest()

    def before(self, start: int) -> list[str]:
        """The two words before, of which the last may touch the span."""
        k = bisect_left(self.starts, start)
        return ["^"] * (2 - min(k, 2)) + [self._word(a, min(b, start)) for a, b in self.spans[max(0, k - 2):k]]

    def after(self, end: int) -> str:
        """The word after, which may touch the span."""
        k = bisect_right(self.ends, end)
        return self._word(max(self.starts[k], end), self.ends[k]) if k < len(self.spans) else "$"


def contexts(words: _Words, start: int, end: int) -> list[str]:
    """Lexical patterns around a span: two words before it; one word before and one after it."""
    far, near = words.before(start)
    return [f"{far} {near} _", f"{near} _ {words.after(end)}"]


def _value(kind_is_email: bool, string: str) -> str:
    return string.lower() if kind_is_email else re.sub(r"[^0-9]", "", string)


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_OCC = pa.struct([("kinds", pa.list_(pa.string())), ("seed", pa.bool_()), ("value", pa.string()), ("start", pa.int32()),
                  ("end", pa.int32()), ("patterns", pa.list_(pa.string()))])
_FOUND = ("rid long, doc_id long, base array<struct<kind:string,start:int,end:int>>, occurrences array<struct<"
          "kinds:array<string>,seed:boolean,value:string,start:int,end:int,patterns:array<string>>>")


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in blocks(batches, "text"):
        texts = texts_of(part)
        base, occurrences = [[] for _ in range(len(texts))], [[] for _ in range(len(texts))]
        marked = pc.match_substring_regex(texts, r"[0-9@]|[(\[]at[)\]]").to_numpy(zero_copy_only=False)
        for k in marked.nonzero()[0].tolist():
            text = texts[k].as_py()
            spans, words = base_spans(text), _Words(text)
            base[k] = [{"kind": kind, "start": s, "end": e} for s, kind, e in spans]
            occurrences[k] = [
                {"kinds": [kind], "seed": True, "value": _value(kind == "email", text[s:e]), "start": s, "end": e,
                 "patterns": contexts(words, s, e)} for s, kind, e in spans]
            occurrences[k] += [
                {"kinds": kinds, "seed": False, "value": _value(kinds == ["email"], text[s:e]), "start": s, "end": e,
                 "patterns": contexts(words, s, e)} for s, e, kinds in candidates(text, spans)]
        yield pa.RecordBatch.from_arrays(
            [part.column("rid"), part.column("doc_id"), pa.array(base, pa.list_(_SPAN)), pa.array(occurrences, pa.list_(_OCC))],
            names=["rid", "doc_id", "base", "occurrences"])


def score_patterns(edges: DataFrame, seeds: DataFrame, compatible: DataFrame, rounds: int | None = None,
                   min_confidence: float = MIN_CONFIDENCE, min_instances: int = MIN_INSTANCES) -> DataFrame:
    """Patterns of high confidence (pattern, kind, confidence) after rounds over the pattern-instance graph.

    edges: distinct (pattern, value); seeds: known (value, kind); compatible: (value, kind) that an instance may be.
    Confidences and known instances only grow from round to round. The rounds end when none does (to 6 decimals), or
    after ``rounds`` of them.
    """
    totals = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    known = seeds.select("value", "kind", F.lit(1.0).alias("score"))
    done, before = 0, None
    while True:
        scored = edges.join(known, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("sum"), F.count("*").alias("k"))
        patterns = materialize(scored.where(F.col("k") >= min_instances).join(totals, "pattern")
                               .withColumn("confidence", F.col("sum") / F.col("n"))
                               .where(F.col("confidence") >= min_confidence).select("pattern", "kind", "confidence"))
        done += 1
        now = patterns.agg(F.count("*").alias("n"), F.sum(F.round("confidence", 6).cast("decimal(20,6)")).alias("sum")).first()
        if done == rounds or not now["n"] or now == before:
            return patterns
        before = now
        found = (edges.join(patterns, "pattern").join(compatible, ["value", "kind"]).groupBy("value", "kind")
                 .agg(F.max("confidence").alias("score")).join(seeds, ["value", "kind"], "left_anti"))
        known = materialize(seeds.select("value", "kind", F.lit(1.0).alias("score")).union(found))


def find_pii(docs: DataFrame, rounds: int | None = None, min_confidence: float = MIN_CONFIDENCE,
             min_instances: int = MIN_INSTANCES) -> DataFrame:
    """Spans of personal data in every document (doc_id, text; other columns are ignored).

    Returns one row per input row: rid (the row's number, monotonically_increasing_id of docs), doc_id, base and added
    (arrays of kind, start, end in code points, by start and then kind as listed). An added span meets no base span and
    no other added one: of those that meet, the first and then the longest stays.
    A null or empty text has none; repeated rows are searched each; a null doc_id stays null.
    """
    return _numbered_pii(docs, F.monotonically_increasing_id(), rounds, min_confidence, min_instances)


def _numbered_pii(docs: DataFrame, rid: Column, rounds: int | None, min_confidence: float, min_instances: int) -> DataFrame:
    source = docs.select(rid.alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = materialize(source.mapInArrow(_find, _FOUND))
    each = found.where("size(occurrences) > 0").select("rid", F.explode("occurrences").alias("o")).select("rid", "o.*")
    edges = materialize(each.select(F.explode("patterns").alias("pattern"), "value").distinct())
    kinds = each.select("value", "seed", F.explode("kinds").alias("kind"))
    seeds = materialize(kinds.where("seed").select("value", "kind").distinct())
    compatible = materialize(kinds.where("NOT seed").select("value", "kind").distinct())
    patterns = score_patterns(edges, seeds, compatible, rounds, min_confidence, min_instances)
    accepted = (each.where("NOT seed")
                .select("rid", "start", "end", F.explode("kinds").alias("kind"), "patterns")
                .select("rid", "start", "end", "kind", F.explode("patterns").alias("pattern"))
                .join(patterns, ["pattern", "kind"]).groupBy("rid", "start", "end")
                .agg(F.max(F.struct("confidence", "kind"))["kind"].alias("kind"))
                .groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", -F.col("end"), "kind"))).alias("all"))
                .select("rid", F.expr("""aggregate(all, named_struct('end', 0, 'kept',
                    cast(array() AS array<struct<kind:string,start:int,end:int>>)),
                    (a, s) -> if(s.start < a.end, a, named_struct('end', -s.col2, 'kept',
                      array_append(a.kept, named_struct('kind', s.kind, 'start', s.start, 'end', -s.col2)))),
                    a -> a.kept)""").alias("added")))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return (found.select("rid", "doc_id", "base").join(accepted, "rid", "left")
            .select("rid", "doc_id", "base", F.coalesce("added", empty).alias("added")))


def joined_spans(spans):
    """kind:start:end of spans, by start and then kind as listed, comma-joined."""
    order = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("k"),
        s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(order), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: str, spans: list[dict]) -> str:
    """The text with each span replaced. Where spans overlap, the first one's placeholder stands for all."""
    out, end = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= end:
            out += [text[end:s["start"]], f"<{s['kind'].upper()}>"]
        end = max(end, s["end"])
    return "".join([*out, text[end:]])


def _redact(column: str, result: str):
    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "text"):
            texts: list[str | None] = [None] * part.num_rows
            for k, spans in enumerate(part.column(column).to_pylist()):
                if spans:
                    texts[k] = redacted(part.column("text")[k].as_py(), spans)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, result])

    return redact


def redact_pii(docs: DataFrame, rounds: int | None = None, min_confidence: float = MIN_CONFIDENCE,
               min_instances: int = MIN_INSTANCES) -> DataFrame:
    """docs with every span of find_pii replaced by its kind in angle brackets; n_chars, if there, is the new length.

    Every other column and every row stay; null and empty texts stay as they are, an empty table gives an empty table.
    The numbered rows are written once and spans and result read that table, since two reads of ``docs`` may number its
    rows differently.
    """
    rid, found, result = fresh(docs, "rid"), fresh(docs, "spans"), fresh(docs, "redacted")
    numbered = materialize(docs.withColumn(rid, F.monotonically_increasing_id()))
    spans = (_numbered_pii(numbered, F.col(rid), rounds, min_confidence, min_instances)
             .select("rid", F.concat("base", "added").alias("spans")).where("size(spans) > 0"))
    spans = materialize(spans.select(F.col("rid").alias(rid), F.col("spans").alias(found)))
    schema = StructType([*numbered.schema.fields, spans.schema[found], StructField(result, StringType())])
    out = (numbered.join(spans, rid, "left").select(*numbered.columns, found)
           .mapInArrow(_redact(found, result), schema))
    changed = {"text": F.coalesce(result, "text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = (F.when(F.col(result).isNotNull(), F.length(result).cast(docs.schema["n_chars"].dataType))
                              .otherwise(F.col("n_chars")))
    return out.withColumns(changed).select(*docs.columns)
