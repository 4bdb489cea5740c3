"""Words and hashes of word windows, as arrays."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

# Fixed value: a word is a run of anything but these white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WHITE_SPACE = " \t\n\x0b\x0c\r"

_WORD = re.compile(WORD.encode())
_REMEMBERED = 200_000  # words whose hash a worker keeps
_LONG = 8 << 20  # bytes of a text whose words are not listed at once
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))


class _Hashes(dict):
    """64-bit hashes by word; starts anew when it has grown to its limit."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


_hashes = _Hashes()


def split_words(text: bytes) -> list[bytes]:
    """``bytes.split`` cuts at the six white-space characters, ``str.split`` at more."""
    return text.split()


def word_hashes(text: bytes | None) -> np.ndarray:
    """One hash per word of the whole text."""
    if not text:
        return np.empty(0, np.uint64)
    if len(text) > _LONG:
        return np.fromiter((_hashes[m.group()] for m in _WORD.finditer(text)), np.uint64)
    words = text.split()
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _C
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring windows."""
    x = left * _A + right * _B
    return (x ^ (x >> np.uint64(29))) * _C


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive values, put together from windows of doubled lengths."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    part, size, whole, done = hashes, 1, None, 0
    while True:
        if n & size:
            if whole is None:
                whole = part
            else:
                rest = part[done:]
                whole = joined(whole[: len(rest)], rest)
            done += size
        if size * 2 > n:
            return mixed(whole[: len(hashes) - n + 1])
        part = joined(part[:-size], part[size:])
        size *= 2


def in_slices(batch: pa.RecordBatch, rows: int = 200) -> Iterator[list[list]]:
    """The columns of a batch as lists, some rows at a time, so that little is held twice."""
    for begin in range(0, batch.num_rows, rows):
        yield [c.to_pylist() for c in batch.slice(begin, rows).columns]


def in_chunks(batch: pa.RecordBatch, limit: int = 2 << 20) -> Iterator[tuple[list, list]]:
    """Keys and texts, the columns of a batch, in runs of about ``limit`` bytes of text."""
    keys, texts, size = [], [], 0
    for some_keys, some_texts in in_slices(batch):
        for key, text in zip(some_keys, some_texts):
            keys.append(key)
            texts.append(text)
            size += len(text or b"")
            if size >= limit:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def forget_hashes() -> None:
    """A function of the module, so that a task clears its worker's own table, not a copy."""
    _hashes.clear()


def giving_back(
    of: Callable[[Iterator], Iterator], forget: Callable[[], None] = forget_hashes
) -> Callable[[Iterator], Iterator]:
    """``of`` for a task; when its rows are through, ``forget`` drops what the task kept for later
    ones, and unused memory goes back to the system. An idle worker that kept it would count beside
    the tasks of other steps."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from of(batches)
        finally:
            forget()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim:
                trim(0)

    return run
