"""Hashes of words and numbers that are the same in every process."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Words whose hash is kept per worker before the table starts afresh.
KEPT_WORDS = 200_000


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 40:
            self[word] = value
        return value


_HASH = _WordHash()


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of a text's words; A-Z count as a-z. (On UTF-8 bytes, lower() and
    split() know A-Z and the six white-space bytes alone.)"""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if len(_HASH) > KEPT_WORDS:
        _HASH.clear()
    return np.fromiter(map(_HASH.__getitem__, found), np.uint64, len(found))


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all 64-bit numbers, one to one."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


#: Longest word whose hash is a sum over its bytes; bytes of words whose sums are made at once.
SUMMED, AT_ONCE = 64, 1 << 20
_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\v\f\r", np.uint8))
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_BYTE = mix(_LOWER.astype(np.uint64) + np.uint64(1))
_PLACE = np.cumprod(np.full(SUMMED, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)


def hashes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, in order, and how many words each text has. A-Z
    count as a-z. The hashes are others than ``word_hashes``: sums over a word's bytes by
    their place, mixed."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(parts), np.uint8)
    edges = np.flatnonzero(np.diff(np.r_[True, _SPACE[data], True]))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    begins = np.cumsum([0] + [len(p) + 1 for p in parts])
    lengths = np.diff(np.searchsorted(starts, begins))
    out = np.empty(len(starts), np.uint64)
    short = np.minimum(sizes, SUMMED)
    total = np.cumsum(short)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + AT_ONCE, "right")))
        n = short[a:b]
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        value = _BYTE[data[np.repeat(starts[a:b], n) + place]] * _PLACE[place]
        out[a:b] = np.add.reduceat(value, first)
        a = b
    out = mix(out + sizes.astype(np.uint64))
    long = np.flatnonzero(sizes > SUMMED)
    if len(long):
        import xxhash

        for i in long.tolist():
            word = data[starts[i]:starts[i] + sizes[i]].tobytes().lower()
            out[i] = xxhash.xxh3_64_intdigest(word)
    return out, lengths


def packed(bucket: np.ndarray, buckets: int, columns: list[np.ndarray]) -> Iterator[list]:
    """(bucket, the columns' bytes) for every bucket that has entries, in their order."""
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    columns = [c[order] for c in columns]
    for b in np.flatnonzero(ends[1:] > ends[:-1]).tolist():
        yield [b, *(c[ends[b]:ends[b + 1]].tobytes() for c in columns)]


def packed_batch(rows: list[list], names: list[str]) -> pa.RecordBatch:
    types = [pa.int32()] + [pa.binary()] * (len(names) - 1)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(names), types)], names)


def unpacked(tbl: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(tbl.column(name).to_pylist()), kind)
