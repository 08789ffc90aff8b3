"""Arrow and numpy kernels over batches of texts, shared by the operators.

A word is a maximal run of characters other than the six ASCII white-space
ones (space, tab, line feed, vertical tab, form feed, carriage return).
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 2 << 20


class Words(NamedTuple):
    """codes: a number for each word; uniq: the word of each number; doc: each word's row; starts: where a row's words begin (one more at the end)."""

    codes: np.ndarray
    uniq: pa.Array
    doc: np.ndarray
    starts: np.ndarray


def texts(column) -> pa.Array:
    """One large_string array, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.offset:  # a copy: some kernels misread what a cast makes of a slice
        column = column.take(pa.array(np.arange(len(column))))
    return pc.fill_null(column.cast(pa.large_string()), "")


#: What one operator keeps for as long as a Python worker lives, which runs the tasks of many.
KEPT: dict = {}


def kept(owner: str) -> dict:
    """The dict of this operator; another's is given up."""
    if KEPT.get("owner") != owner:
        KEPT.clear()
        KEPT["owner"] = owner
    return KEPT


def release() -> None:
    """Gives memory that freed batches have left in a worker back to the machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES, owner: str = "") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `limit` bytes of text (a longer text makes one of its own), so that memory follows `limit`."""
    kept(owner)
    for b in batches:
        if not b.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(size)
        at = 0
        while at < b.num_rows:
            before = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + limit, side="right")))
            yield b.slice(at, end - at)
            at = end
        del b
        release()


def words(column, lower: bool = False) -> Words:
    """Splits texts into words; lower: A-Z become a-z first."""
    t = texts(column)
    if lower:
        t = pc.ascii_lower(t)
    split = pc.ascii_split_whitespace(t)
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = split.flatten()
    doc = np.repeat(np.arange(len(t)), counts)
    full = pc.greater(pc.binary_length(flat), 0)
    if not pc.all(full, min_count=0).as_py():
        mask = full.to_numpy(zero_copy_only=False)
        flat, doc = flat.filter(full), doc[mask]
    coded = flat.dictionary_encode()
    starts = np.zeros(len(t) + 1, np.int64)
    np.cumsum(np.bincount(doc, minlength=len(t)), out=starts[1:])
    return Words(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, doc, starts)


def hashed(uniq: pa.Array, seed: int = 0) -> np.ndarray:
    """XXH64 of each string's UTF-8 bytes, unsigned."""
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(u, seed) for u in uniq.cast(pa.large_binary()).to_pylist()), np.uint64, len(uniq))


def signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def mix(a: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads each bit over all (splitmix64's finaliser)."""
    a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))


def rolling(h: np.ndarray, k: int, base: int) -> np.ndarray:
    """A 64-bit hash of each k consecutive values: sum of h[i+j] * base**j, mixed. base is odd."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power = np.full(len(h) + 1, base, np.uint64)
    power[0] = 1
    inverse = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    sums = np.zeros(len(h) + 1, np.uint64)
    power = np.cumprod(power)
    np.cumsum(h * power[:-1], out=sums[1:])
    return mix((sums[k:] - sums[:n]) * np.cumprod(inverse))


def inside(doc: np.ndarray, k: int) -> np.ndarray:
    """For each k consecutive words: whether one row has them all."""
    n = max(0, len(doc) - k + 1)
    return doc[:n] == doc[k - 1 : k - 1 + n]


def per_doc(mask: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of mask (bool or numbers) over each row's words."""
    sums = np.zeros(len(mask) + 1, np.float64 if mask.dtype.kind == "f" else np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[starts[1:]] - sums[starts[:-1]]


def byte_counts(t: pa.Array, chars: bytes) -> np.ndarray:
    """How many of these ASCII characters each text has."""
    data, offsets = raw(t)
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return per_doc(table[data], offsets)


def raw(t: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A large_string array's bytes and offsets into them."""
    _, offsets, data = t.buffers()
    off = np.frombuffer(offsets, np.int64, len(t) + 1, t.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]
