"""Whole texts as flat word arrays, in Arrow and numpy, for use inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_LIBC = ctypes.CDLL(None)
#: Bytes of text handled at once; a longer text is handled alone.
SLICE_BYTES = 4 << 20
#: Odd multiplier of the rolling hashes.
BASE = np.uint64(0x9E3779B97F4A7C15)


def fold_table(is_word, lower: bool) -> bytes:
    """A byte translation: bytes outside words become spaces, A-Z lower case on request."""
    table = bytearray()
    for b in range(256):
        c = b + 32 if lower and 65 <= b <= 90 else b
        table.append(c if is_word(c) else 32)
    return bytes(table)


#: Words are runs of anything but ASCII white space.
LOWER = fold_table(lambda b: True, lower=True)
#: Words are runs of a-z, 0-9 and non-ASCII characters.
LOWER_ALNUM = fold_table(lambda b: b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122, lower=True)


#: Bytes of text after which a worker gives freed memory back, and how many it has read since.
RELEASE_BYTES = 24 << 20
_READ = [0]
#: What a worker keeps between tasks, of one operator at a time.
_KEPT: dict[str, object] = {}


def kept(key: str, make: Callable[[], object]) -> object:
    """What the worker keeps under the key; what it kept for others goes."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Keep nothing of other operators."""
    _KEPT.clear()


def release() -> None:
    """Give memory that is free back to the system: Arrow's pool and the C heap hold on to it."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def slices(batch: pa.RecordBatch, column: str = "text", target: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about `target` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cut = (np.cumsum(sizes) - sizes) // target
    starts = np.flatnonzero(np.r_[True, cut[1:] != cut[:-1]]) if len(sizes) else []
    for a, b in zip(starts, [*starts[1:], len(sizes)]):
        yield batch.slice(a, b - a)
    _READ[0] += int(sizes.sum())
    if _READ[0] > RELEASE_BYTES:
        _READ[0] = 0
        release()


def plain(text: pa.Array) -> pa.Array:
    """The texts with null as empty, in buffers of their own that start at offset 0."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    return pa.concat_arrays([text]) if text.offset == 0 else pa.array(text.to_pylist(), pa.large_string())


def translate(text: pa.Array, table: bytes | None) -> pa.Array:
    """The texts with every byte replaced; a table must keep UTF-8 valid, and lengths stay."""
    text = plain(text)
    if table is None or not len(text):
        return text
    valid, offsets, data = text.buffers()
    return pa.Array.from_buffers(pa.large_string(), len(text), [valid, offsets, pa.py_buffer((data.to_pybytes() if data else b"").translate(table))])


def split_words(text: pa.Array, table: bytes | None = None) -> tuple[np.ndarray, pa.Array]:
    """Offsets by text, and all words in order: runs without ASCII white space after translation."""
    lists = pc.ascii_split_whitespace(translate(text, table))
    words, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    ends -= ends[0] if len(ends) else 0
    full = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    if not full.all():
        ends = np.r_[0, np.cumsum(full)][ends]
        words = words.filter(pa.array(full))
    return ends, words


def word_hashes(words: pa.Array, wide: bool = False) -> tuple[np.ndarray, ...]:
    """A 64-bit hash for each word, or the two halves of a 128-bit one."""
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    at = coded.indices.to_numpy(zero_copy_only=False)
    if not wide:
        each = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
        return (each[at],)
    each = np.frombuffer(b"".join(xxhash.xxh3_128_digest(w) for w in coded.dictionary.to_pylist()), np.uint64).reshape(-1, 2)
    return each[at, 0], each[at, 1]


def rolling(h: np.ndarray, k: int, base: np.uint64 = BASE) -> np.ndarray:
    """The hash of the k words from each position, over text borders too; at the end fewer positions."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out, done, power, width, part = None, 0, base, 1, h
    with np.errstate(over="ignore"):
        while True:
            if k & width:
                out = part if out is None else out[: len(part) - done] * power + part[done:] if done else part
                done += width
            if width * 2 > k:
                return mixed(out[: len(h) - k + 1])
            part, power, width = part[:-width] * power + part[width:], power * power, width * 2


def mixed(x: np.ndarray) -> np.ndarray:
    """The values with their bits spread evenly."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def sliding(x: np.ndarray, k: int, pick=np.minimum) -> np.ndarray:
    """The least (or greatest) of the k values from each position."""
    if len(x) < k:
        return x[:0]
    width = 1
    n = len(x) - k + 1
    while width * 2 <= k:
        x, width = pick(x[:-width], x[width:]), width * 2
    return x[:n] if width == k else pick(x[:n], x[k - width : k - width + n])


def windows(ends: np.ndarray, k: int) -> np.ndarray:
    """Which positions of the flat words start k words of one text."""
    n = int(ends[-1]) if len(ends) else 0
    ok = np.zeros(max(0, n - k + 1), bool)
    sizes = np.diff(ends)
    has = sizes >= k
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, ends[:-1][has], 1)
    np.add.at(step, ends[1:][has] - k + 1, -1)
    ok[:] = np.cumsum(step)[: len(ok)] > 0
    return ok


def covered(n: int, starts: np.ndarray, k: int) -> np.ndarray:
    """Which of n words lie in one of the k-word windows at `starts`."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + k, n), -1)
    return np.cumsum(step)[:n] > 0


def owners(ends: np.ndarray) -> np.ndarray:
    """The text that each word is of."""
    return np.repeat(np.arange(len(ends) - 1), np.diff(ends))
