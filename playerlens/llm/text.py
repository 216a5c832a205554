"""Words, hashes and training folds that the operators share.

Texts are handled as UTF-8 bytes: lower-casing A-Z and splitting on ASCII characters never cuts a
longer character. Long texts are split block by block, so a word list stays bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerlens.session import cut_lineage

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
#: Everything below 0x80 but digits and letters becomes a space.
ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)
_SPACES = np.isin(np.arange(256), np.frombuffer(b" \t\n\v\f\r", np.uint8))
BLOCK_BYTES = 1 << 20
_MASK = (1 << 64) - 1
_FACTOR = 0x9E3779B97F4A7C15


def blocks(data: bytes) -> Iterator[bytes]:
    """``data`` in pieces of about a megabyte, cut before white space only."""
    start = 0
    while start < len(data):
        end = start + BLOCK_BYTES
        while end < len(data) and not _SPACES[data[end]]:
            end += 1
        yield data[start:end]
        start = end


class WordHasher:
    """64-bit hashes of all words of a text, by one polynomial over its bytes.

    Built inside a task: the tables of powers are not sent around. Two different words get one hash
    with a chance of about 2**-64.
    """

    def __init__(self, table: bytes):
        self.table = table
        self.values = mix64(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
        self._grow(BLOCK_BYTES + 1024)

    def _grow(self, n: int) -> None:
        self.powers = np.cumprod(np.full(n, _FACTOR, np.uint64))
        self.inverse = np.cumprod(np.full(n, pow(_FACTOR, -1, 1 << 64), np.uint64))

    def _block(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        a = np.frombuffer(b" " + data + b" ", np.uint8)
        if len(a) > len(self.powers):
            self._grow(2 * len(a))
        inside = ~_SPACES[a]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edges[0::2], edges[1::2]
        total = np.cumsum(self.values[a] * self.powers[: len(a)])
        return starts - 1, mix64((total[ends - 1] - total[starts - 1]) * self.inverse[starts])

    def one(self, data: bytes | None) -> np.ndarray:
        parts = [self._block(x)[1] for x in blocks((data or b"").translate(self.table))]
        return parts[0] if len(parts) == 1 else np.concatenate([np.empty(0, np.uint64), *parts])

    def many(self, texts: list[bytes | None]) -> Iterator[np.ndarray]:
        """The hashes of each text in turn; short texts are hashed together."""
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and size < BLOCK_BYTES // 4:
                size += len(texts[to] or b"") + 1
                to += 1
            if to == at + 1:
                yield self.one(texts[at])
            else:
                group = [(x or b"") for x in texts[at:to]]
                if size > BLOCK_BYTES:
                    yield from map(self.one, group)
                else:
                    starts, hashes = self._block(b" ".join(group).translate(self.table))
                    cuts = np.searchsorted(starts, np.cumsum([len(x) + 1 for x in group])[:-1])
                    yield from np.split(hashes, cuts)
            at = to


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers with full avalanche."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` words in a row."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(m, np.uint64)
    factor = 1
    for i in range(n):
        factor = factor * _FACTOR & _MASK
        out += hashes[i : i + m] * np.uint64(factor)
    return mix64(out)


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's longs."""
    return x.view(np.int64)


def fold(doc_id: Column, n: int) -> Column:
    """The remainder of crc32 of the id's decimal text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def space_words(text: Column) -> Column:
    """How many words without ASCII white space ``text`` has; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sample_of(rows: DataFrame, column: str, n: int) -> DataFrame:
    """``n`` distinct values of ``column``, or all when there are fewer, chosen by their hash alone.

    The share that is kept follows from an estimate of how many distinct values there are, so copies
    do not shrink the sample; tasks give up only what is used, and equal values are merged before
    they meet. Should too few be kept, a larger share is drawn.
    """
    share = share_of(rows.agg(F.approx_count_distinct(F.xxhash64(column))).first()[0], n)
    while True:
        kept = rows.filter(F.pmod(F.xxhash64(column), F.lit(share)) == 0).select(column).distinct()
        kept = cut_lineage(kept)
        if share == 1 or kept.count() >= n:
            return kept.orderBy(F.xxhash64(column), column).limit(n)
        share //= 2


def share_of(distinct: int, n: int) -> int:
    """One in how many hashes leaves about half as many again as ``n`` of ``distinct`` values."""
    return max(1, 2 * distinct // (3 * n))


def set_aside(docs: DataFrame, names: list[str]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with its columns called ``names`` renamed, and how to select all columns as before."""
    aside = {c: f"_own_{c}" for c in docs.columns if c in names}
    kept = [F.col(aside[c]).alias(c) if c in aside else F.col(c) for c in docs.columns]
    return docs.withColumnsRenamed(aside), kept
