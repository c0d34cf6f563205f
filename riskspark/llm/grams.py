"""Counts of byte n-grams of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Texts are handled in groups of about this many bytes. Groups bound memory; no result depends on them.
GROUP_BYTES = 3_000_000
DOC_BITS = 20


def groups(sizes: Iterable[int], limit: int = GROUP_BYTES) -> Iterator[slice]:
    """Consecutive slices of rows whose sizes add up to about ``limit``; at least one row each."""
    start = total = at = 0
    for at, size in enumerate(sizes, 1):
        total += size
        if total >= limit or at - start >= 1 << DOC_BITS:
            yield slice(start, at)
            start, total = at, 0
    if at > start:
        yield slice(start, at)


def gram_runs(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every distinct (gram, text) with its count, sorted by gram and text.

    A gram is ``order`` (at most 4) bytes, oldest in the highest place. A text is preceded by ``order - 1`` zero bytes
    and followed by one, so that its first bytes and its end are predicted too: a text of n bytes has n + 1 grams.
    """
    before = bytes(order - 1)
    data = np.frombuffer(b"".join(before + t + b"\0" for t in texts), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + order
    ends = np.cumsum(lengths)
    gram = np.zeros(len(data) - order + 1, np.uint64)
    for k in range(order):
        gram = (gram << np.uint64(8)) | data[k : len(data) - order + 1 + k]
    # Grams that begin in one text and end in the next are those whose first byte is among the last order - 1 bytes.
    inside = np.ones(len(data), bool)
    for k in range(1, order):
        inside[ends - k] = False
    doc = np.repeat(np.arange(len(texts), dtype=np.uint64), lengths)
    keys = (gram << np.uint64(DOC_BITS) | doc[: len(gram)])[inside[: len(gram)]]
    keys.sort()
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return keys >> np.uint64(DOC_BITS), (keys & np.uint64((1 << DOC_BITS) - 1)).astype(np.int64), counts
