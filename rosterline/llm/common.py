"""Shared helpers: staged tables, text buffers without Python strings, and vectorised word hashes.

Words are told apart by 64-bit hashes. Byte values are looked up in a fixed random table, folded with a
polynomial and mixed, so equal words have equal hashes in every task and session.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from rosterline.session import ensure_adaptive, fresh_path

RECORDS_PER_BATCH = 1000
SLICE_BYTES = 1 << 20

_MASK = (1 << 64) - 1
_PRIME = 0x9E3779B97F4A7C15
_INVERSE = pow(_PRIME, -1, 1 << 64)


def prepare(spark: SparkSession) -> SparkSession:
    """Adaptive execution, and Arrow batches small enough for a Python worker beside others."""
    ensure_adaptive(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(RECORDS_PER_BATCH))
    return spark


@contextmanager
def prompt_cleanup(spark: SparkSession) -> Iterator[None]:
    """Within, shuffle files go when their query ends, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def tidy(step: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """The step of a task; at its end, freed memory that Arrow and the C library hold on to goes back to the system.

    A Python worker lives on after its task, beside the executor's heap, and so do the pages of its largest task.
    """

    @functools.wraps(step)
    def rows(*args, **kwargs) -> Iterator[pa.RecordBatch]:
        yield from step(*args, **kwargs)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
        if trim:
            trim(0)

    return rows


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again, which cuts its lineage."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.staged_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        fs, place = file_system(table.staged_at)
        fs.delete_dir(place)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """A file system that tasks can use for a path or URI in the shared folder."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_PRIME)) | np.uint64(1)


def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def letters_and_digits() -> np.ndarray:
    """Byte values of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; 0 elsewhere."""
    keep = np.zeros(256, bool)
    keep[48:58] = keep[97:123] = keep[128:] = True
    low = _lowered()
    return np.where(keep[low], _byte_values()[low], np.uint64(0))


def not_blank(fold: bool = True) -> np.ndarray:
    """Byte values of words ``[^\\x20\\x09-\\x0D]+``, by default after lower-casing A-Z; 0 elsewhere."""
    keep = np.ones(256, bool)
    keep[[32, 9, 10, 11, 12, 13]] = False
    low = _lowered() if fold else np.arange(256)
    return np.where(keep[low], _byte_values()[low], np.uint64(0))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, at least n of each."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, min(2 * n, SLICE_BYTES + 1))
        for name, base in (("up", _PRIME), ("down", _INVERSE)):
            steps = np.full(size, base & _MASK, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; NULL reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    raw = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[raw[0] : raw[-1]] if data is not None else np.empty(0, np.uint8)
    return data, raw - raw[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes stay near the limit; a longer row has a range of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def _words_of_piece(data: np.ndarray, breaks: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every word; ``breaks`` are positions at which a word ends in any case."""
    n = len(data)
    value = values[data]
    inside = value != 0
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[breaks] = False
    begin = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[breaks[breaks > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(value * up[:n], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64)), begin, end


def words(data: np.ndarray, offsets: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and per row the index of its first word (one more entry than rows)."""
    hashes, _, _, at = located_words(data, offsets, values)
    return hashes, at


def located_words(data: np.ndarray, offsets: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash, first byte and end of every word, and per row the index of its first word.

    ``values`` gives a byte's value, 0 for bytes that part words. Rows part words as well. A long text is
    read in pieces that end between words, so memory does not follow the longest text.
    """
    n, at = len(data), 0
    hashes, begins, ends = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while at < n:
        end = min(at + SLICE_BYTES, n)
        while end < n and values[data[end]] and values[data[end - 1]]:
            gap = np.flatnonzero(values[data[max(at, end - 4096) : end]] == 0)
            if len(gap) and max(at, end - 4096) + gap[-1] > at:
                end = int(max(at, end - 4096) + gap[-1])
                break
            end = min(end + 4096, n)
        inner = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end)] - at
        found, begin, stop = _words_of_piece(data[at:end], inner, values)
        hashes.append(found)
        begins.append(begin + at)
        ends.append(stop + at)
        at = end
    begin = np.concatenate(begins)
    return np.concatenate(hashes), begin, np.concatenate(ends), np.searchsorted(begin, offsets).astype(np.int64)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive entries, by position of the first."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total = total * np.uint64(_PRIME) + hashes[k : k + count]
    return mix(total)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every range, one after the other."""
    total = int(lengths.sum())
    if total == 0:
        return np.empty(0, np.int64)
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return shift + np.arange(total, dtype=np.int64)


class SortedHashes:
    """Sorted 64-bit keys with a slot table over their leading bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(1, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.searchsorted(keys >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Position of each hash, -1 where it is not stored."""
        found = np.full(len(wanted), -1, np.int32)
        if len(self.keys) == 0:
            return found
        slot = (wanted >> self.shift).astype(np.int64)
        at, end = self.slots[slot], self.slots[slot + 1]
        key = self.keys[np.minimum(at, len(self.keys) - 1)]
        hit = (key == wanted) & (at < end)
        found[hit] = at[hit]
        live = np.flatnonzero(~hit & (at + 1 < end))
        place = at[live] + 1
        while len(live):
            key, want = self.keys[place], wanted[live]
            hit = key == want
            found[live[hit]] = place[hit]
            on = ~hit & (key < want) & (place + 1 < end[live])
            live, place = live[on], place[on] + 1
        return found
