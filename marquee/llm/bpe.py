"""Byte-level BPE encoding and decoding.

A segment tree over the byte positions of a piece of text holds, at each node, the smallest pair
``rank * width + position`` below it, so the root is the leftmost pair of least rank. A merge changes at most
three leaves (the merged pair, the pair to its left, the pair it swallowed) and their paths to the root. Short
pieces are merged side by side: one numpy row per piece, one step merges one pair in every row. Long pieces use
the same tree on their own. Distinct pieces are encoded once per worker, in a cache of bounded size.
"""

from __future__ import annotations

import base64
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LETTER, NOT_PLAIN, NUMBER, SPACE, id_and_text, kept, per_batch, slices, texts_of

#: No pair; larger than any rank shifted by POS bits.
NONE = np.int64(1) << 62
POS = 32
#: Pieces up to so many bytes are merged side by side, as many as have so many bytes together.
SHORT, TOGETHER = 64, 1 << 17
#: Distinct pieces a worker remembers before it starts anew.
CACHE = 200_000


#: Fixed value: the usual pattern of such vocabularies; for plain Latin text ``re`` runs it as PLAIN_PIECES.
KNOWN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_PIECES = re.compile(f" ?[{LETTER}]+| ?[{NUMBER}]+|'(?:[stmd]|re|ve|ll)| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+").findall


class Ranks:
    """The merge ranks of one vocabulary file (base64 token, space, rank on each line)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        self.token = {r: t for t, r in self.rank.items()}
        self.find = regex.compile(pattern).findall
        self.find_plain = PLAIN_PIECES if pattern == KNOWN else self.find
        self.bits = max(self.token).bit_length()
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        self.pair = {}
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                a, b = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if a is not None and b is not None:
                    self.pair[a << self.bits | b] = rank
        self.keys = np.array(sorted(self.pair), np.int64)
        self.ranks = np.array([self.pair[k] for k in self.keys.tolist()], np.int64)
        self.cache: dict[str, bytes] = {}  # the ids of a piece as 32-bit integers

    def of_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; NONE where the pair isn't a token or ``b`` is -1."""
        key = a << self.bits | np.maximum(b, 0)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (b >= 0), self.ranks[at], NONE >> POS)

    def encode_pieces(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        out: list[tuple[int, ...] | None] = [None] * len(pieces)
        rows: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if piece in self.rank:
                out[i] = (self.rank[piece],)
            elif len(piece) <= SHORT:
                rows.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
            else:
                out[i] = tuple(self._merge_long(piece))
        for width, mine in rows.items():
            for start in range(0, len(mine), TOGETHER // width):
                part = mine[start : start + TOGETHER // width]
                for i, ids in zip(part, self._merge_side_by_side([pieces[i] for i in part], width)):
                    out[i] = ids
        return out

    def _merge_side_by_side(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        n, cols = len(pieces), np.arange(width)
        lengths = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        inside = cols < lengths[:, None]
        ids = np.where(inside, self.byte[raw], -1)
        ids = np.concatenate([ids, np.full((n, 1), -1)], axis=1)  # column `width`: nothing
        after = np.where(cols + 1 < lengths[:, None], cols + 1, width)
        before = np.broadcast_to(np.where(cols > 0, cols - 1, width), (n, width))
        before = np.concatenate([before, np.full((n, 1), width)], axis=1)
        after = np.concatenate([after, np.full((n, 1), width)], axis=1)
        leaf = (self.of_pairs(ids[:, :-1], np.take_along_axis(ids, after[:, :-1], 1)) << POS) | cols
        leaf[~inside] = NONE
        leaf[leaf >> POS == NONE >> POS] = NONE
        tree = np.full((n, 2 * width), NONE)
        tree[:, width:] = leaf
        node = width
        while node > 1:
            half = node >> 1
            tree[:, half:node] = np.minimum(tree[:, node : 2 * node : 2], tree[:, node + 1 : 2 * node : 2])
            node = half
        live = np.flatnonzero(tree[:, 1] < NONE)
        while len(live):
            top = tree[live, 1]
            at, merged = top & ((1 << POS) - 1), top >> POS
            gone = after[live, at]
            right = after[live, gone]
            left = before[live, at]
            ids[live, at], ids[live, gone] = merged, -1
            after[live, at] = right
            some = right < width
            before[live[some], right[some]] = at[some]
            self._set(tree, live, gone, np.full(len(live), NONE), width)
            self._set(tree, live, at, self._leaf(merged, ids[live, right], at), width)
            some = left < width
            who, where = live[some], left[some]
            self._set(tree, who, where, self._leaf(ids[who, where], merged[some], where), width)
            live = live[tree[live, 1] < NONE]
        kept = ids[:, :width] >= 0
        flat = ids[:, :width][kept].tolist()
        ends = np.cumsum(kept.sum(1)).tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *ends], ends)]

    def _leaf(self, a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
        rank = self.of_pairs(a, b)
        return np.where(rank < NONE >> POS, rank << POS | at, NONE)

    @staticmethod
    def _set(tree: np.ndarray, rows: np.ndarray, at: np.ndarray, value: np.ndarray, width: int) -> None:
        node = at + width
        tree[rows, node] = value
        while width > 1:
            width >>= 1
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def _merge_long(self, piece: bytes) -> list[int]:
        n = len(piece)
        width = 1 << (n - 1).bit_length()
        none, pair, bits = int(NONE), self.pair, self.bits
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * width)
        for i in range(n - 1):
            rank = pair.get(ids[i] << bits | ids[i + 1])
            if rank is not None:
                tree[width + i] = rank << POS | i
        for node in range(width - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b

        def put(at: int, value: int) -> None:
            node = at + width
            tree[node] = value
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                least = a if a < b else b
                if tree[node] == least:
                    return
                tree[node] = least
                node >>= 1

        while tree[1] < none:
            at, merged = tree[1] & ((1 << POS) - 1), tree[1] >> POS
            gone = after[at]
            right, left = after[gone], before[at]
            ids[at], ids[gone], after[at] = merged, -1, right
            put(gone, none)
            rank = None
            if right < n:
                before[right] = at
                rank = pair.get(merged << bits | ids[right])
            put(at, none if rank is None else rank << POS | at)
            if left >= 0:
                rank = pair.get(ids[left] << bits | merged)
                put(left, none if rank is None else rank << POS | left)
        return [i for i in ids if i >= 0]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Token ids of each text: every match of the pattern on its own."""
        ids = np.arange(max(self.token) + 1).astype(object)
        return [ids[np.frombuffer(x, np.int32)].tolist() for x in self.coded(texts)]

    def coded(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text as 32-bit integers. The pieces of a text take many times its size, so only some texts
        are in pieces at a time."""
        return list(chain.from_iterable(self._coded(texts[part]) for part in slices(texts)))

    def _coded(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > CACHE:
            self.cache.clear()
        split = [(self.find if NOT_PLAIN(t) else self.find_plain)(t) for t in texts]
        known = [list(map(self.cache.get, pieces)) for pieces in split]
        short = [i for i, row in enumerate(known) if None in row]
        new = list({p for i in short for p, ids in zip(split[i], known[i]) if ids is None})
        self.cache.update(zip(new, (array("i", ids).tobytes() for ids in self.encode_pieces([p.encode() for p in new]))))
        for i in short:
            known[i] = map(self.cache.__getitem__, split[i])
        return [b"".join(row) for row in known]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def ranks(path: str, pattern: str) -> Ranks:
    return kept(("bpe", path, pattern), lambda: Ranks(path, pattern))


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """``doc_id, ids array<int>`` for every row, and with ``decode`` the bytes the ids decode to.

    Rows are neither dropped nor merged: null and empty texts give no ids, repeated rows repeat, further
    columns of the input are not read. The vocabulary file must be at ``path`` on every machine.
    """
    schema = "doc_id bigint, ids array<int>" + (", decoded binary" if decode else "")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = ranks(path, pattern)
        coded = coder.coded(texts_of(batch))
        out = [batch.column("doc_id"), _lists(coded)]
        if decode:
            out.append(pa.array([coder.decode(np.frombuffer(x, np.int32).tolist()) for x in coded], pa.binary()))
        return pa.RecordBatch.from_arrays(out, names=["doc_id", "ids", "decoded"][: len(out)])

    return per_batch(id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long")), work, schema, ("bpe", path, pattern))


def decode_documents(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, decoded binary`` from ``doc_id, ids``; null ids give empty bytes."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = ranks(path, pattern)
        made = [coder.decode(x or []) for x in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.binary())], names=["doc_id", "decoded"])

    return per_batch(rows.select("doc_id", "ids"), work, "doc_id bigint, decoded binary", ("bpe", path, pattern))


def _lists(coded: list[bytes]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in coded])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), np.int32)))
