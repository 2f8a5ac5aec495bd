"""Personal data by bootstrapped contextual extraction.

Four kinds are found by their form: e-mail and IP addresses, card and phone numbers. These are the seeds. Every
other number or address-like token is a candidate. The words around seeds and candidates are patterns, each with a
loose class of the value (address-like, or a range of digit counts) and once more with its exact layout; a pattern's confidence in a kind is the share of the distinct values it surrounds
that are known to be of that kind. Patterns of high confidence make their other values known, which changes the
confidence of further patterns, and so on. The graph of patterns and values is held and scored by Spark; texts
are read once.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .common import id_and_text, per_batch, text_key, texts_of

KINDS = ("email", "ip", "card", "phone")
#: The forms of the kinds (fixed values). Digit runs can't be entered in the middle by a match that starts at
#: their first digit, so the look-behind changes no result; it keeps long runs from being tried at each digit.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_CANDIDATE = re.compile(r"[+(]?[0-9](?:[ ().:/-]{0,2}[0-9]){4,}")
_WORD = re.compile(r"\w+")
_FOUND = "array<struct<kind:int,start:int,end:int,value:string,cues:array<string>>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(index of the kind, start, end) of what the forms find, by kind and start."""
    out, last = [], 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            last = m.end()
            out.append((0, start, last))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = re.sub("[ -]", "", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return out


def shape(value: str) -> str:
    short = re.sub(r"[0-9]+", lambda m: f"9{len(m.group())}", value)
    return re.sub(r"[^\W\d_]+", "a", short)


def looks(value: str) -> str:
    """A class wide enough for every notation of a kind: addresses, and numbers by their count of digits."""
    if "@" in value:
        return "@"
    n = sum(c.isdigit() for c in value)
    return "few" if n < 7 else "some" if n < 16 else "many"


def cues(text: str, start: int, end: int) -> list[str]:
    """Patterns around a span: the word before, the two before, the word after, each with the class of the value
    and with its layout."""
    before = [w.lower() for w in _WORD.findall(text[max(0, start - 64) : start])[-2:]]
    after = _WORD.search(text[end : end + 48])
    out = [f"<{before[-1]}"] if before else []
    if len(before) == 2:
        out.append(f"<<{before[0]} {before[1]}")
    if after:
        out.append(f">{after.group().lower()}")
    forms = (looks(text[start:end]), shape(text[start:end]))
    return [f"{words}|{form}" for words in out for form in forms]


def instances(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int | None, int, int, str, list[str]]]:
    """Seeds and candidates: kind (None for candidates), start, end, value, patterns."""
    out: list = [(k, s, e, text[s:e], cues(text, s, e)) for k, s, e in base]
    spans = sorted((s, e) for _, s, e in base)
    other = [m.span() for m in _CANDIDATE.finditer(text)]
    at = text.find("@")
    while at >= 0:
        s, e = at, at + 1
        while s > 0 and not text[s - 1].isspace():
            s -= 1
        while e < len(text) and not text[e].isspace():
            e += 1
        if s < at < e - 1:
            other.append((s, e))
        at = text.find("@", e)
    i = 0
    for s, e in sorted(other):
        while i < len(spans) and spans[i][1] <= s:
            i += 1
        if not any(a < e and s < b for a, b in spans[i : i + 8]):
            out.append((None, s, e, text[s:e], cues(text, s, e)))
    return out


def scan(rows: DataFrame) -> DataFrame:
    """``key, doc_id, base, found`` of rows ``key, doc_id, text``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, found = [], []
        for text in texts_of(batch):
            spans = base_spans(text)
            base.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
            found.append([{"kind": k, "start": s, "end": e, "value": v, "cues": c} for k, s, e, v, c in instances(text, spans)])
        span = [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]
        kinds = [pa.list_(pa.struct(span)), pa.list_(pa.struct([*span, ("value", pa.string()), ("cues", pa.list_(pa.string()))]))]
        return pa.RecordBatch.from_arrays([batch.column("key"), batch.column("doc_id"), pa.array(base, kinds[0]), pa.array(found, kinds[1])], names=["key", "doc_id", "base", "found"])

    return per_batch(rows, work, f"key binary, doc_id bigint, base array<struct<kind:int,start:int,end:int>>, found {_FOUND}")


def bootstrap(scanned: DataFrame, least_values: int = 4, confidence: float = 0.8, certainty: float = 0.95) -> DataFrame:
    """``key, added``: the spans the patterns add to each text, in ``found`` of ``scan``.

    A pattern counts with at least ``least_values`` known values of a kind and a confidence of at least
    ``confidence`` (known / (all + 1)); a value becomes known when the patterns around it leave less than
    1 - ``certainty`` of doubt. Of the two patterns of the same words the surer one counts, as they don't stand
    for themselves. Copies of a text count once. Rounds go on until none makes a new value known, which comes
    to an end since known values stay known.
    """
    texts = scanned.filter(F.size("found") > 0).groupBy("key").agg(F.first("found").alias("found"))
    spans = cut_lineage(texts.select("key", F.inline("found")))
    graph = spans.select("value", F.explode("cues").alias("cue")).distinct()
    known = spans.filter("kind is not null").groupBy("value").agg(F.min("kind").alias("kind"))
    # Patterns without a single candidate can't add anything.
    open_values = spans.select("value").distinct().join(known, "value", "left_anti")
    useful = graph.join(open_values, "value").select("cue").distinct()
    graph = cut_lineage(graph.join(useful, "cue"))
    known = cut_lineage(known)
    while True:
        sides = graph.join(known, "value", "left")
        counts = sides.groupBy("cue").agg(F.count("*").alias("n"), *(F.count_if(F.col("kind") == k).alias(f"n{k}") for k in range(len(KINDS))))
        best = F.array_max(F.array(*(F.struct(F.col(f"n{k}").alias("hits"), F.lit(-k).alias("k")) for k in range(len(KINDS)))))
        patterns = counts.withColumn("best", best).select("cue", (-F.col("best.k")).alias("kind"), F.col("best.hits").alias("hits"), (F.col("best.hits") / (F.col("n") + 1)).alias("sure"))
        patterns = patterns.filter((F.col("hits") >= least_values) & (F.col("sure") >= confidence))
        judged = sides.filter("kind is null").select("value", "cue").join(patterns, "cue")
        judged = judged.groupBy("value", "kind", F.substring_index("cue", "|", 1).alias("words")).agg(F.max("sure").alias("sure")).groupBy("value", "kind").agg(F.sum(F.log(1 - F.col("sure"))).alias("doubt"))
        new = judged.groupBy("value").agg(F.min(F.struct("doubt", "kind")).alias("m")).filter(F.exp("m.doubt") <= 1 - certainty)
        new = cut_lineage(new.select("value", F.col("m.kind").alias("kind")))
        if new.isEmpty():
            break
        known = known.unionByName(new)
    added = spans.filter("kind is null").drop("kind").join(known, "value")
    return added.groupBy("key").agg(F.collect_set(F.struct("kind", "start", "end")).alias("added"))


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``doc_id, base, added`` for every row: arrays of (kind, start, end), code points, the end exclusive,
    ordered by kind and start; ``kind`` is the index in ``KINDS``. ``base`` is what the forms find, ``added``
    what the patterns add, which never overlaps it.

    Null and empty texts have no spans; repeated rows repeat; an empty table gives an empty result; extra
    columns are not read.
    """
    rows = id_and_text(docs, id_col, text_col).select(text_key("text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    scanned = cut_lineage(scan(rows))
    added = bootstrap(scanned, **settings)
    joined = scanned.select("key", "doc_id", "base").join(added, "key", "left")
    return joined.select("doc_id", "base", F.coalesce(F.array_sort("added"), F.array().cast("array<struct<kind:int,start:int,end:int>>")).alias("added"))


def mask(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", **settings) -> DataFrame:
    """The input with every span replaced by its kind in brackets, such as ``[EMAIL]``; overlapping spans are
    one, named after the first. ``length_col``, if there, becomes the new length. Null texts stay null. The
    columns are those of the input, none of which may be called ``_pii_key`` or ``_pii_added``."""
    rows = docs.select(text_key(F.col(text_col).cast("string")).alias("key"), F.lit(None).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    added = cut_lineage(bootstrap(cut_lineage(scan(rows)), **settings)).select(F.col("key").alias("_pii_key"), F.col("added").alias("_pii_added"))
    if added.isEmpty():  # then texts needn't be moved
        joined = docs.withColumn("_pii_added", F.lit(None).cast("array<struct<kind:int,start:int,end:int>>"))
    else:
        joined = docs.withColumn("_pii_key", text_key(F.col(text_col).cast("string"))).join(added, "_pii_key", "left").drop("_pii_key")

    names = docs.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for text, more in zip(batch.column(text_col).to_pylist(), batch.column("_pii_added").to_pylist()):
            texts.append(None if text is None else masked(text, base_spans(text) + [(x["kind"], x["start"], x["end"]) for x in more or ()]))
        columns = {n: batch.column(n) for n in names}
        columns[text_col] = pa.array(texts, pa.string())
        if length_col in columns:
            columns[length_col] = pa.array([None if t is None else len(t) for t in texts], columns[length_col].type)
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return per_batch(joined.select(*docs.columns, "_pii_added"), work, T.StructType(docs.schema.fields))


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at, open_end = [], 0, -1
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start < open_end:
            open_end = at = max(open_end, end)
            continue
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = open_end = end
    return "".join([*out, text[at:]])
