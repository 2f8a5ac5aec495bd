"""Token counts by two tiers of lookups on the map side.

The first tier is a table of the lengths (in tokens) of the corpus' most frequent pre-tokens. It is found by
one pass in which every partition keeps its most frequent pre-tokens; the lists are merged pairwise on the
executors, cut to ``table_size`` entries each time, and the table that is broadcast therefore never has more.
The second tier is a cache in each Python worker, of bounded size, filled by encoding what the table lacks.
Counts never depend on what either tier holds. No pre-token is ever shuffled.
"""

from __future__ import annotations

import functools
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LETTER, NOT_PLAIN, NUMBER, SPACE, id_and_text, per_batch, texts_of

#: How the vocabulary's own pre-tokenizer splits plain text: letters, single digits, the rest.
SPLIT = re.compile(f"[{LETTER}]+|'(?:[stmd]|re|ve|ll)|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+").findall
#: Worker cache, in pre-tokens and in their characters, beside the table.
CACHE, CHARACTERS = 400_000, 8_000_000


class Lengths(dict):
    """Tokens per pre-token: the table, then the cache, then the tokenizer."""

    def __init__(self, tokenizer, table: dict[str, int]):
        super().__init__(table)
        self.tokenizer, self.table, self.held = tokenizer, table, 0

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(self) >= len(self.table) + CACHE or self.held + len(piece) > CHARACTERS:
            self.clear()
            self.update(self.table)
            self.held = 0
        if len(piece) <= CHARACTERS:
            self[piece] = n
            self.held += len(piece)
        return n


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


_LENGTHS: dict[str, Lengths] = {}


@functools.lru_cache(maxsize=2)
def _special(path: str) -> re.Pattern:
    """The special strings that stand for themselves inside a text."""
    strings = sorted((t.content for t in tokenizer(path).get_added_tokens_decoder().values()), key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, strings)) + ")" if strings else "((?!))")


def pieces_of(text: str, path: str) -> list[str]:
    """Pre-tokens of a text: by the plain pattern where it holds, else by the tokenizer's own steps."""
    if "<|" not in text and not NOT_PLAIN(text):
        return SPLIT(text.lower())
    out: list[str] = []
    coder = tokenizer(path)
    for nth, part in enumerate(_special(path).split(text)):
        if nth % 2:
            out.append(part)
        elif NOT_PLAIN(part):
            fitted = coder.normalizer.normalize_str(part)
            out += [fitted[a:b] for _, (a, b) in coder.pre_tokenizer.pre_tokenize_str(fitted)]
        else:
            out += SPLIT(part.lower())
    return out


def frequent(docs: DataFrame, path: str, table_size: int = 16_384) -> list[str]:
    """The most frequent pre-tokens of all texts; partitions' lists are merged in a tree on the executors."""

    def lists(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text in texts_of(batch):
                seen.update(pieces_of(text, path))
            if len(seen) > 8 * table_size:
                seen = Counter(dict(seen.most_common(4 * table_size)))
        top = seen.most_common(table_size)
        yield pa.RecordBatch.from_arrays([pa.array([[w for w, _ in top]], pa.list_(pa.string())), pa.array([[n for _, n in top]], pa.list_(pa.int64()))], names=["pieces", "counts"])

    def merge(a: Counter, b: Counter) -> Counter:
        return Counter(dict((a + b).most_common(table_size)))

    rows = docs.select("text").mapInArrow(lists, "pieces array<string>, counts array<bigint>")
    summed = rows.rdd.map(lambda r: Counter(dict(zip(r["pieces"], r["counts"]))))
    return [w for w, _ in summed.treeReduce(merge, depth=2).most_common(table_size)] if summed.getNumPartitions() else []


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", table_size: int = 16_384) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row, as the tokenizer file at ``path`` gives them.

    Null and empty texts have no tokens, repeated rows repeat, an empty table gives an empty result, further
    columns of the input are not read. Texts of any script and length go through both tiers; special strings
    inside a text are pre-tokens of their own.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    coder = tokenizer(path)
    words = frequent(rows, path, table_size)
    table = {w: len(e.ids) for w, e in zip(words, coder.encode_batch(words, add_special_tokens=False))}
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if path not in _LENGTHS or _LENGTHS[path].table is not sent.value:
            _LENGTHS[path] = Lengths(tokenizer(path), sent.value)
        length = _LENGTHS[path].__getitem__
        texts = texts_of(batch)
        counts = [sum(map(length, pieces_of(text, path))) for text in texts]
        sizes = [len(t.encode()) for t in texts]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts])],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    return per_batch(rows, work, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
