"""Terms of whole texts as byte spans: runs of ASCII letters and digits and of anything beyond ASCII, with A-Z
in lower case. Worked out for many texts at once; long texts go in pieces that end between terms."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np

#: What a byte becomes: itself, the lower-case letter, or 0 between terms.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[: ord("0")] = 0
FOLD[ord("9") + 1 : ord("a")] = 0
FOLD[ord("z") + 1 : 128] = 0
FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)

#: Bytes of text handled at a time, and the length above which a term is hashed by itself.
PIECE, LONG = 1 << 20, 48
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & np.uint32(1), (_CRC >> np.uint32(1)) ^ np.uint32(0xEDB88320), _CRC >> np.uint32(1))


def pieces(texts: list[bytes | None], overlap: int = 0) -> Iterator[tuple[list[int], list[bytes], np.ndarray]]:
    """Numbers of texts, the bytes of each (whole, or a part of a long one), and how many terms at its
    beginning stood in the part before already."""
    held: list[tuple[int, bytes, int]] = []
    size = 0
    for i, text in enumerate(texts):
        text = text or b""
        start, seen = 0, 0
        while True:
            end = _gap(text, start + PIECE)
            held.append((i, text[start:end] if start or end < len(text) else text, seen))
            size += end - start
            if size >= PIECE:
                yield [h[0] for h in held], [h[1] for h in held], np.array([h[2] for h in held])
                held, size = [], 0
            if end >= len(text):
                break
            start, seen = _back(text, end, overlap)
    if held:
        yield [h[0] for h in held], [h[1] for h in held], np.array([h[2] for h in held])


def _gap(text: bytes, at: int) -> int:
    """The first place between terms at or after ``at``."""
    while at < len(text):
        free = np.flatnonzero(FOLD[np.frombuffer(text, np.uint8, min(1 << 16, len(text) - at), at)] == 0)
        if len(free):
            return at + int(free[0])
        at += 1 << 16
    return len(text)


def _back(text: bytes, end: int, terms: int) -> tuple[int, int]:
    """Where the last ``terms`` terms before ``end`` begin, and how many there are."""
    wide = 1 << 10
    while terms:
        low = max(0, end - wide)
        starts, _ = edges(FOLD[np.frombuffer(text, np.uint8, end - low, low)])
        if len(starts) > terms or not low:
            starts = starts[-terms:]
            return (low + int(starts[0]), len(starts)) if len(starts) else (end, 0)
        wide *= 4
    return end, 0


def edges(folded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the terms of folded bytes."""
    edge = np.diff(np.concatenate([[0], (folded != 0).astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one run of bytes with one space after each term, and of every term the place of its text
    in the list, start and end."""
    joined = FOLD[np.frombuffer(b"\0".join([*texts, b""]), np.uint8)]
    inside = joined != 0
    after = np.concatenate([[False], inside[:-1]]) & ~inside
    # A text ends where its closing zero stands.
    closes = np.cumsum([len(t) + 1 for t in texts])
    starts, _ = edges(joined)
    doc = np.searchsorted(closes, starts, "right")
    data = joined[inside | after]
    data[data == 0] = 0x20
    ends = np.flatnonzero(data == 0x20)
    return data, doc, np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends, ends


def crc32_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of each span, all spans one byte further at each step."""
    size = ends - starts
    out = np.empty(len(size), np.uint32)
    for i in np.flatnonzero(size > LONG):
        out[i] = zlib.crc32(data[starts[i] : ends[i]])
    short = np.flatnonzero(size <= LONG)
    short = short[np.argsort(LONG - size[short].astype(np.uint8), kind="stable")]
    at, left = starts[short], size[short]
    live = np.searchsorted(-left, -np.arange(1, LONG + 1), "right")
    state = np.full(len(short), 0xFFFFFFFF, np.uint32)
    for step, n in enumerate(live.tolist()):
        if not n:
            break
        now = state[:n]
        state[:n] = _CRC[(now ^ data[at[:n] + step]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out[short] = ~state
    return out
