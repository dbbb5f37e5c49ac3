"""Word and shingle hashes over whole Arrow string batches, vectorised.

A batch's UTF-8 buffer is hashed with a handful of numpy passes over eight-byte
chunks of its words; only words of more than ``LONG_WORD`` bytes are digested
one by one.  A-Z is lower-cased; a word is a maximal run of bytes other than
space, tab, LF, VT, FF, CR.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 21
#: Longer words, in bytes, are digested one by one.
LONG_WORD = 64


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (a bijection of 64-bit integers)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each document and each word's document index.

    ``buf`` holds the UTF-8 bytes; document k is ``buf[starts[k]:ends[k]]``
    (ascending, not overlapping).  Works in pieces of ``PIECE_BYTES`` cut at
    word ends, so one very long document costs no more scratch memory.
    """
    hashes, owners = [], []
    k, lo, n_docs = 0, 0, len(starts)
    while k < n_docs:
        lo = max(lo, int(starts[k]))
        last = k
        hi = int(ends[k])
        if hi - lo > PIECE_BYTES:  # a long document: cut it after a word
            hi = lo + PIECE_BYTES
            while hi < ends[k] and not _SPACE[buf[hi]]:
                hi += 1
        else:
            while last + 1 < n_docs and int(ends[last + 1]) - lo <= PIECE_BYTES:
                last += 1
            hi = int(ends[last])
        if hi > lo:
            h, at = _piece(buf[lo:hi], starts[k + 1:last + 1] - lo)
            hashes.append(h)
            owners.append(np.searchsorted(starts[k:last + 1], at + lo, side="right") - 1 + k)
        if hi >= ends[last]:
            k = last + 1
        lo = hi
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def _piece(b: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the words of ``b``; a word also ends at a cut."""
    word = ~_SPACE[b]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    inner = cuts[(cuts > 0) & (cuts < len(b))]
    begins[inner] = word[inner]
    stops = word.copy()
    stops[:-1] &= ~word[1:]
    before = inner - 1
    stops[before] = word[before]
    s, e = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return _hashed(b, s, e - s), s


def _hashed(b: np.ndarray, s: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of every ``b[s:s + size]``, A-Z lower-cased.

    Words are taken in eight-byte chunks, each mixed into the state before the
    next one is added, one chunk of all words at a time.
    """
    low = np.zeros(len(b) + 8, np.uint8)
    low[:len(b)] = _LOWER[b]
    at = np.ndarray((len(b) + 1,), np.uint64, low.data, strides=(1,))  # the eight bytes from each offset on
    h = mix64(size.astype(np.uint64) * np.uint64(0xA24BAED4963EE407) + np.uint64(1))
    short = size <= LONG_WORD
    live = np.flatnonzero(short)
    done = 0
    while len(live):
        left = size[live] - done
        chunk = at[s[live] + done]
        part = left < 8
        chunk[part] &= (np.uint64(1) << (left[part] * 8).astype(np.uint64)) - np.uint64(1)
        h[live] = mix64(h[live] * np.uint64(0x9FB21C651E98DF25) + chunk)
        done += 8
        live = live[left > 8]
    for k in np.flatnonzero(~short):
        word = low[s[k]:s[k] + size[k]]
        h[k] = int.from_bytes(hashlib.blake2b(word.data, digest_size=8).digest(), "little")
    return h


def shingle_hashes(words: np.ndarray, owners: np.ndarray, n: int, also: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document index of every ``n``-word shingle, and of the shorter
    ones of ``also`` words.

    A document with 1 to n-1 words gives its whole word sequence as one.
    """
    out, own = [], []
    for m in (n, *also):
        if len(words) >= m:
            ok = owners[m - 1:] == owners[:len(owners) - m + 1]
            i = np.flatnonzero(ok)
            out.append(combine([words[i + k] for k in range(m)]))
            own.append(owners[i])
    if len(words):
        first = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
        size = np.diff(np.r_[first, len(owners)])
        for k in range(1, n):
            f = first[size == k]
            if len(f):
                out.append(combine([words[f + j] for j in range(k)]))
                own.append(owners[f])
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h, o = np.concatenate(out), np.concatenate(own)
    if len(out) > 1:
        by = np.argsort(o, kind="stable")
        h, o = h[by], o[by]
    return h, o


def combine(parts: list[np.ndarray]) -> np.ndarray:
    acc = np.full(len(parts[0]), np.uint64(len(parts)), np.uint64)
    for p in parts:
        acc = mix64(acc * np.uint64(0x9FB21C651E98DF25) + p)
    return acc


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends) of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if not pa.types.is_binary(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return buf, off[:-1], off[1:]


def group_shingles(col: pa.Array, n: int, also: tuple[int, ...] = ()) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(shingle hashes, row of each), in text order, for groups of rows of
    together about ``PIECE_BYTES`` of text; a row is never split."""
    buf, starts, ends = text_buffer(col)
    for a, b in row_groups(starts, ends):
        w, o = word_hashes(buf, starts[a:b], ends[a:b])
        h, own = shingle_hashes(w, o, n, also)
        if len(h):
            yield h, own + a


def word_counts(col: pa.Array) -> np.ndarray:
    """Number of words of every row."""
    out = np.zeros(len(col), np.int64)
    buf, starts, ends = text_buffer(col)
    for a, b in row_groups(starts, ends):
        _, o = word_hashes(buf, starts[a:b], ends[a:b])
        out[a:b] = np.bincount(o, minlength=b - a)
    return out


def doc_shingles(col: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, shingle hashes in text order) for every row that has words."""
    for h, own in group_shingles(col, n):
        cut = np.flatnonzero(own[1:] != own[:-1]) + 1
        for seg, row in zip(np.split(h, cut), own[np.r_[0, cut]]):
            yield int(row), seg


def row_groups(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive rows of together at most ``PIECE_BYTES`` bytes (one at least)."""
    a, size = 0, 0
    for k in range(len(starts)):
        more = int(ends[k] - starts[k])
        if k > a and size + more > PIECE_BYTES:
            yield a, k
            a, size = k, 0
        size += more
    if a < len(starts):
        yield a, len(starts)
