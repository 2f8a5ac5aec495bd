"""Language identification of mixed-language text.

A model holds log probabilities of the letter n-grams of each language and the scripts each language uses.
The script of a word narrows its candidate languages; its score for each of them is the sum over its n-grams.
A Viterbi pass over the words, in which changing the language costs a penalty, labels every word, and runs of
words with one label are the spans. All documents of a batch take each step together. Documents in which no stretch
of words speaks for another language than the best one by half the penalty are labelled without the pass: a path
with changes has at least as many of them as stretches in other languages, or one less and two at least of
these, so it can't win.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
from bisect import bisect_right
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, per_batch, texts_of

WORD = re.compile(r"[^\W\d_]+")
#: What that class holds besides letters: numbers that are no decimal digits, such as fractions.
_NUMBERS = "".join(c for c in map(chr, range(0x110000)) if c.isalnum() and not c.isdecimal() and unicodedata.category(c)[0] != "L")
_LETTERS = re.compile(rf"[^\W\d_{_NUMBERS}]+")
_IS_NUMBER = np.zeros(0x110000, bool)
_IS_NUMBER[[ord(c) for c in _NUMBERS]] = True
#: First code points of script ranges; letters between two starts belong to the first.
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0700, "other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "other"), (0x0B80, "Tamil"), (0x0C00, "other"),
    (0x0E00, "Thai"), (0x0E80, "other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "other"), (0x1E00, "Latin"),
    (0x1F00, "Greek"), (0x2000, "Latin"), (0x2C00, "other"), (0x2C60, "Latin"), (0x2C80, "other"), (0x3040, "Kana"),
    (0x3100, "other"), (0x3130, "Hangul"), (0x3190, "other"), (0x3400, "Han"), (0xA000, "other"), (0xAC00, "Hangul"),
    (0xD7B0, "other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB07, "other"), (0xFF21, "Latin"), (0xFF5B, "other"), (0x20000, "Han"),
]
_STARTS = [s for s, _ in SCRIPTS]
#: Words and letters of words that a worker remembers before it starts anew.
CACHE, LETTERS = 500_000, 8_000_000


def words_in(text: str) -> list[str]:
    """The runs of letters of a text."""
    odd = not text.isascii() and _IS_NUMBER[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].any()
    return (_LETTERS if odd else WORD).findall(text)


def script(letter: str) -> str:
    return SCRIPTS[bisect_right(_STARTS, ord(letter)) - 1][1]


def grams(word: str) -> list[str]:
    """Bigrams and trigrams of the word between boundary marks; of long words the same, however many."""
    padded = f"<{word}>"
    return [padded[i : i + 2] for i in range(len(padded) - 1)] + [padded[i : i + 3] for i in range(len(padded) - 2)]


class Model:
    def __init__(self, counts: dict[str, dict[str, int]], scripts: dict[str, dict[str, int]], docs: dict[str, int]):
        self.langs = sorted(docs)
        vocabulary = {g for c in counts.values() for g in c}
        floors, table = [], {}
        for i, lang in enumerate(self.langs):
            own = counts.get(lang, {})
            total = sum(own.values()) + 0.5 * (len(vocabulary) + 1)
            floors.append(math.log(0.5 / total))
            for g, n in own.items():
                table.setdefault(g, {})[i] = math.log((n + 0.5) / total)
        self.floor = np.array(floors)
        keys = {_code(g): [row.get(i, floors[i]) - floors[i] for i in range(len(self.langs))] for g, row in table.items()}
        self.grams = np.array(sorted(keys), np.int64)
        self.gains = np.array([keys[k] for k in self.grams.tolist()]).reshape(len(keys), len(self.langs))
        self.scripts: dict[str, np.ndarray] = {}
        for i, lang in enumerate(self.langs):
            seen = scripts.get(lang, {})
            for name, n in seen.items():
                if n >= 0.01 * sum(seen.values()):
                    self.scripts.setdefault(name, np.zeros(len(self.langs), bool))[i] = True
        self.prior = max(self.langs, key=lambda x: (docs[x], x)) if self.langs else None

    def scores(self, words: list[str]) -> np.ndarray:
        """Log-likelihood ratios of each word; -50 below the rest for languages that don't use its script."""
        n = len(self.langs)
        out = np.zeros((len(words), n), np.float32)
        for start, end in _portions(words):
            part = words[start:end]
            text = np.frombuffer("".join(f"<{w}>" for w in part).lower().encode("utf-32-le"), np.uint32).astype(np.int64)
            opens = np.flatnonzero(text == 60)
            two = (text[:-1] << 21) | text[1:]
            three = (two[:-1] << 21) | text[2:]
            # No n-gram goes on after the end of a word.
            at = [np.flatnonzero(text[:-1] != 62), np.flatnonzero((text[:-2] != 62) & (text[1:-1] != 62))]
            owner = np.concatenate([np.searchsorted(opens, a, "right") - 1 for a in at])
            codes = np.concatenate([two[at[0]], three[at[1]]])
            place = np.minimum(np.searchsorted(self.grams, codes), max(0, len(self.grams) - 1))
            known = np.flatnonzero(self.grams[place] == codes) if len(self.grams) else place[:0]
            count = np.bincount(owner, minlength=len(part))
            gains, to = self.gains[place[known]], owner[known]
            value = np.stack([self.floor[i] * count + np.bincount(to, gains[:, i], minlength=len(part)) for i in range(n)], axis=1)
            value -= value.max(1, keepdims=True)
            own = self._users(np.array([ord(w[0]) for w in part]))
            value = np.where(own, value, value.min(1, keepdims=True) - 50)
            out[start:end] = np.where(own.any(1, keepdims=True), value, 0)
        return out

    def _users(self, letters: np.ndarray) -> np.ndarray:
        """Which languages use the script of each letter."""
        names = [name for _, name in SCRIPTS]
        table = np.array([self.scripts.get(name, np.zeros(len(self.langs), bool)) for name in names])
        return table[np.searchsorted(_STARTS, letters, "right") - 1]


def _code(gram: str) -> int:
    code = 0
    for c in gram:
        code = code << 21 | ord(c)
    return code


def _portions(words: list[str], letters: int = 1 << 19):
    """Ranges of words that have about so many letters together."""
    start = size = 0
    for i, w in enumerate(words):
        size += len(w) + 2
        if size >= letters:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(words):
        yield start, len(words)


def learn(docs: DataFrame, may_learn: Column, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", docs_per_language: int = 4000, grams_per_language: int = 30_000) -> Model:
    """Counts n-grams over a bounded sample: of each language the rows whose text hashes into the share that
    gives ``docs_per_language`` rows on average (all rows, if there are fewer). Only rows with a language, a
    text and ``may_learn`` true are used."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), may_learn.alias("use"))
    rows = rows.filter("use and lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model({}, {}, {})
    share = F.create_map(*(F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(1.0, docs_per_language / n))))
    chosen = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000)

    def count(batches):
        for batch in batches:
            seen: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                seen.setdefault(lang, Counter()).update(words_in(text))
            rows = []
            for lang, words in seen.items():
                found: Counter = Counter()
                for word, n in words.items():
                    found["\0" + script(word[0])] += n * len(word)
                    for g in grams(word.lower()):
                        found[g] += n
                rows += [(lang, g, n) for g, n in found.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["lang", "gram", "n"])

    counted = chosen.select("lang", "text").mapInArrow(count, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.substring("gram", 1, 1) != "\0", F.desc("n"), "gram")
    counts, scripts = {}, {}
    for r in counted.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= grams_per_language).collect():
        to, key = (scripts, r["gram"][1:]) if r["gram"].startswith("\0") else (counts, r["gram"])
        to.setdefault(r["lang"], {})[key] = r["n"]
    return Model(counts, scripts, sizes)


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word. ``scores`` has the words of all documents one after the other; documents
    take each step together, the longest first, so that those still running are a prefix."""
    total, n = scores.shape
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    labels = np.zeros(total, np.int16)
    if not total:
        return labels
    running = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
    came = np.full(scores.shape, -1, np.int16)  # the label before, where it was another one
    value = scores[starts[: running[0]]].copy()
    last = value.copy()
    for t in range(1, sizes[0]):
        m = running[t]
        if m < len(value):
            last[m : len(value)] = value[m:]
            value = value[:m]
        at = starts[:m] + t
        best = value.argmax(1)
        top = value[np.arange(m), best] - penalty
        jump = value < top[:, None]
        if jump.any():
            value = np.where(jump, top[:, None], value)
            came[at] = np.where(jump, best[:, None], -1)
        value = value + scores[at]
        if t % 64 == 0:
            value -= value.max(1, keepdims=True)
    last[: len(value)] = value
    state = last.argmax(1)
    labels[starts[: running[0]] + sizes[: running[0]] - 1] = state
    for t in range(sizes[0] - 1, 0, -1):
        m = running[t]
        at = starts[:m] + t
        now = labels[at]
        before = came[at, now]
        labels[at - 1] = np.where(before >= 0, before, now)
    return labels


def steady(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """The best single language of each text with words, and whether no path with a change can be better."""
    starts = np.cumsum(lengths) - lengths
    best = np.add.reduceat(scores, starts, axis=0, dtype=np.float64).argmax(1)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    own = scores[np.arange(len(scores)), best[doc]].astype(np.float64)
    fine = np.ones(len(lengths), bool)
    for k in range(scores.shape[1]):
        ahead = np.cumsum(scores[:, k] - own)
        ahead -= np.concatenate([[0.0], ahead])[starts][doc]
        # Each text stands so much lower than the one before that the least value so far is always its own.
        step = 2 * (np.abs(ahead).max() + 1)
        ahead -= doc * step
        least = np.minimum(np.minimum.accumulate(ahead), -doc * step)
        fine &= np.maximum.reduceat(ahead - least, starts) < penalty / 2 - 1e-3
    return best, fine


class _Worker:
    """Word scores of one model in one Python worker."""

    def __init__(self, model: Model):
        self.model = model
        self._empty()

    def _empty(self) -> None:
        self.code: dict[str, int] = {}
        self.table = np.zeros((1 << 12, len(self.model.langs)), np.float32)
        self.letters = 0

    def codes(self, words: list[str]) -> np.ndarray:
        new = list(set(words).difference(self.code))
        if new:
            start = len(self.code)
            self.code.update(zip(new, range(start, start + len(new))))
            self.letters += sum(map(len, new))
            if len(self.code) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros((max(len(self.table), len(new)), self.table.shape[1]), np.float32)])
            self.table[start : start + len(new)] = self.model.scores(new)
        return np.fromiter(map(self.code.__getitem__, words), np.int64, count=len(words))

    def label(self, texts: list[str], penalty: float) -> list[tuple[str, float, list]]:
        model = self.model
        out: list[tuple[str, float, list]] = [("und", 0.0, [])] * len(texts)
        if not model.langs:
            return out
        if len(self.code) > CACHE or self.letters > LETTERS:
            self._empty()
        words = [words_in(t) for t in texts]
        some = [i for i, w in enumerate(words) if w]
        if not some:
            return out
        sizes = np.array([len(words[i]) for i in some], np.int64)
        codes = self.codes(list(chain.from_iterable(words)))
        scores = self.table[codes]
        best, fine = steady(scores, sizes, penalty)
        for i, b in zip(np.array(some)[fine].tolist(), best[fine].tolist()):
            out[i] = (model.langs[b], 1.0, [(0, len(texts[i]), model.langs[b])])
        mixed = np.flatnonzero(~fine)
        if not len(mixed):
            return out
        labels = viterbi(scores[np.repeat(~fine, sizes)], sizes[mixed], penalty)
        start = 0
        for i, size in zip(np.array(some)[mixed].tolist(), sizes[mixed].tolist()):
            mine, own, text = labels[start : start + size], words[i], texts[i]
            letters = np.fromiter(map(len, own), np.int64, count=size)
            share = np.bincount(mine, weights=letters, minlength=len(model.langs)) / letters.sum()
            cuts = np.flatnonzero(np.diff(mine)) + 1
            bounds, at, place = [0], 0, 0
            for cut in cuts.tolist():  # where the first word of each further span begins
                while place <= cut:
                    at = text.index(own[place], at) + (len(own[place]) if place < cut else 0)
                    place += 1
                bounds.append(at)
                at += len(own[cut])
            bounds.append(len(text))
            spans = [(a, b, model.langs[int(mine[k])]) for a, b, k in zip(bounds, bounds[1:], [0, *cuts.tolist()])]
            top = int(share.argmax())
            out[i] = (model.langs[top], min(1.0, float(share[top])), spans)
            start += size
        return out


_WORKERS: dict[str, _Worker] = {}


def identify(docs: DataFrame, model: Model, penalty: float = 8.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang, score, spans`` for every row: the language of most letters, their share, and the spans
    (start, end in characters, language) of the text.

    Null and empty texts and texts without a letter are ``und`` with score 0, as is every text when nothing
    was learned. Words in a script no language uses follow their neighbours. Repeated rows repeat; further
    columns of the input are not read. Ties go to the first language by name.
    """
    sent, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        worker = _WORKERS.get(name)
        if worker is None:
            _WORKERS.clear()
            worker = _WORKERS[name] = _Worker(sent.value)
        found = worker.label(texts_of(batch), penalty)
        spans = pa.array([[{"start": a, "end": b, "lang": x} for a, b, x in s] for _, _, s in found], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([f[0] for f in found]), pa.array([f[1] for f in found]), spans], names=["doc_id", "lang", "score", "spans"])

    rows = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return per_batch(rows, work, "doc_id bigint, lang string, score double, spans array<struct<start:int,end:int,lang:string>>")
