"""Vectorised text scanning on the buffers of Arrow string columns."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
_MUL = np.uint64(0x9E3779B97F4A7C15)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after another, and the offsets of each; null is empty."""
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64, n + 1, column.offset * 8) if at is not None else np.zeros(n + 1, np.int64)
    size = int(offsets[-1] - offsets[0])
    raw = np.frombuffer(data, np.uint8, size, int(offsets[0])) if size else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def chunks(raw: np.ndarray, offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first, last + 1, bytes, offsets."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, to, raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def byte_class(spec: str) -> np.ndarray:
    """Boolean table of the bytes that belong to words: ``space`` or ``alnum``."""
    out = np.ones(256, bool)
    if spec == "space":
        out[[9, 10, 11, 12, 13, 32]] = False
    else:
        out[:128] = False
        out[48:58] = out[97:123] = out[65:91] = True
    return out


def lower_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, which never cross a text's end, and words before each text."""
    n = len(is_word)
    before = np.zeros(n + 1, bool)
    before[1:] = is_word
    here = np.zeros(n + 1, bool)
    here[:n] = is_word
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(here & (~before | cut))
    ends = np.flatnonzero(before & (~here | cut))
    return starts, ends, np.searchsorted(starts, offsets)


@lru_cache(maxsize=1)
def _salt(seed: int) -> tuple[np.ndarray, int]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1), int(rng.integers(1 << 40, 1 << 62)) | 1


def _run(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to the n-th."""
    base = _salt(seed)[1]
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        x = np.full(n + 1, b, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


_kept = lru_cache(maxsize=1)(_run)


def _powers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One table serves all runs of texts of usual size; longer ones get a table that isn't kept."""
    return (_salt(seed)[0], *(_kept(2 * CHUNK, seed) if n <= 2 * CHUNK else _run(n, seed)))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 11) -> np.ndarray:
    """64-bit hash of each span, by prefix sums of a polynomial: linear in the bytes, however long a word."""
    salt, power, inverse = _powers(len(data), seed)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(salt[data] * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _MUL)


def utf32(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts and their offsets."""
    data = raw.tobytes()
    try:
        points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
    except UnicodeDecodeError:
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        return points, np.cumsum([0, *map(len, texts)])
    heads = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=heads[1:])
    return points, heads[offsets]
