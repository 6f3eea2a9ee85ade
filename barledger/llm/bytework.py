"""Vectorised work on the bytes of many texts at once, used inside tasks."""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute

U64 = np.uint64
MULTIPLIER = U64(0x9E3779B97F4A7C15)
BASE = 0x2545F4914F6CDD1D


def byte_table(excluded: str | bytes | list[int]) -> np.ndarray:
    """True for every byte that is not excluded."""
    table = np.ones(256, dtype=bool)
    table[np.frombuffer(bytes(excluded), dtype=np.uint8)] = False
    return table


#: Words that white space (\x20, \x09-\x0D) separates.
SPACE_WORDS = byte_table([0x20, *range(0x09, 0x0E)])
#: Words of a-z, 0-9 (after lower-casing) and all code points above \x7F, whose UTF-8 bytes are all above \x7F too.
PLAIN_WORDS = byte_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: A-Z to a-z, other bytes to themselves.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def worker_cache(name: str) -> dict:
    """What a Python process keeps between its tasks: functions come to it by value, each time with new globals.

    Functions that need no tables of their own call release() first.
    """
    module = sys.modules.setdefault("barledger_worker_cache", types.ModuleType("barledger_worker_cache"))
    return module.__dict__.setdefault(name, {})


def release(name: str) -> None:
    """Drops what another operator's tasks kept in this process."""
    worker_cache(name).clear()


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    with np.errstate(over="ignore"):
        x = values.astype(U64, copy=True)
        x ^= x >> U64(30)
        x *= U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(27)
        x *= U64(0x94D049BB133111EB)
        x ^= x >> U64(31)
    return x


with np.errstate(over="ignore"):
    #: A fixed odd 64-bit code for each byte.
    BYTE_CODES = mixed(np.arange(1, 257, dtype=U64) * MULTIPLIER) | U64(1)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 … base ** (n - 1) modulo 2 ** 64."""
    known = worker_cache("powers")
    have = known.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.ones(size, dtype=U64)
        done = 1
        with np.errstate(over="ignore"):
            while done < size:
                have[done : 2 * done] = have[:done] * U64(pow(base, done, 1 << 64))
                done *= 2
        known[base] = have
    return have[:n]


def bounded(batches, text: int, most: int = 2 << 20):
    """The record batches, cut so that column `text` of each has at most so many bytes, or one row."""
    for batch in batches:
        column = batch.column(text)
        sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(ends):
            before = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, before + most, side="right")), at + 1)
            yield batch.slice(at, to - at)
            at = to


class Texts:
    """Texts of a batch in one byte array, a line feed after each; nulls are empty."""

    def __init__(self, column: pa.Array | pa.ChunkedArray | list[bytes | None], lower: bool = False):
        if not isinstance(column, list):
            column = column.cast(pa.binary()).to_pylist()
        texts = [x or b"" for x in column]
        self.n = len(texts)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=self.n)
        self.lengths = lengths
        self.starts = np.zeros(self.n + 1, dtype=np.int64)
        np.cumsum(lengths + 1, out=self.starts[1:])
        self.bytes = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
        if lower:
            self.bytes = LOWER[self.bytes]
        self._sums: np.ndarray | None = None

    @property
    def sums(self) -> np.ndarray:
        """Prefix sums of code(byte i) * BASE ** i; a slice's difference, scaled back, is a hash of its content."""
        if self._sums is None:
            with np.errstate(over="ignore"):
                values = BYTE_CODES[self.bytes]
                values *= powers(BASE, len(values))
                self._sums = np.zeros(len(values) + 1, dtype=U64)
                np.cumsum(values, out=self._sums[1:])
        return self._sums

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the content of each slice."""
        with np.errstate(over="ignore"):
            h = self.sums[ends] - self.sums[starts]
            h *= powers(pow(BASE, -1, 1 << 64), len(self.bytes) + 1)[starts]
            h += (ends - starts).astype(U64) * MULTIPLIER
        return mixed(h)

    def count_before(self, flags: np.ndarray) -> np.ndarray:
        """How many of the flagged bytes lie before each byte, and before the end."""
        out = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=out[1:])
        return out


class Words:
    """Words of Texts: maximal runs of the bytes that table allows; `first[d]` is the index of text d's first word."""

    def __init__(self, texts: Texts, table: np.ndarray):
        inside = table[texts.bytes].view(np.int8)
        if texts.n:
            inside[texts.starts[1:] - 1] = 0
        edges = np.diff(inside, prepend=np.int8(0), append=np.int8(0))
        self.starts = np.flatnonzero(edges == 1)
        self.ends = np.flatnonzero(edges == -1)
        self.first = np.searchsorted(self.starts, texts.starts)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(texts.n), self.counts)
        self.hashes = texts.hashes(self.starts, self.ends)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of `width` consecutive hashes (there are len - width + 1; none if that is negative)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, dtype=U64)
        for j in range(width):
            total *= U64(BASE)
            total += hashes[j : j + n]
    return mixed(total)


def sums_by(doc: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """The sum of values for each of n texts."""
    return np.bincount(doc, weights=values, minlength=n).astype(np.int64)


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs twice or more, and whether it occurs at a smaller index."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    twice, later = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    later[order[1:][same]] = True
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice, later


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n positions lie in one of the windows of `width` positions that begin at starts."""
    change = np.zeros(n + width + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.cumsum(change)[:n] > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true flags."""
    edges = np.diff(flags.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
