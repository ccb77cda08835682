"""Benchmark decontamination by suffix arrays of the training text.

Every slice of the documents is a shard: its words, in order, with a separator after each document, get a suffix
array. Every suffix of every benchmark item is binary-searched in each shard; the search keeps the range of
training suffixes that share its first d words and narrows it word by word, so it ends with all longest verbatim
matches and their locations. Matches of at least ``window`` words (or of a whole shorter item) mark the words that
they cover.

Documents never leave their task and nothing is shuffled. The benchmark is stored once as word hashes; tasks
read it block by block, and keep it only while it is smaller than ``KEPT_TEST_BYTES``.

Rows: NULL and empty texts have no words and are never contaminated; repeated document rows are judged one by
one; items without item_id or words match nothing; items that share an item_id count once; other columns of
the documents are ignored by ``scan`` and kept by ``decontaminate``, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import buffers, file_system, letters_and_digits, prepare, ragged, slices, tidy, words
from rosterline.session import fresh_path

WINDOW = 10
SEGMENT_WORDS = 1 << 20
TEST_WORDS = 1 << 18
KEPT_TEST_BYTES = 64 << 20

MATCH = "struct<item_id:string,item_start:long,doc_start:long,words:long>"
SCAN = f"doc_id long, n_words long, n_hit long, n_items long, longest long, items array<string>, matches array<{MATCH}>"


class SuffixArray:
    """Suffixes of a word sequence, sorted by their first ``depth`` words.

    Ranks by the first w words give ranks by 3w words with one sort of packed rank triples; only suffixes that
    are still tied are sorted again.
    """

    def __init__(self, hashes: np.ndarray, depth: int):
        n = len(hashes)
        self.vocabulary, inverse = np.unique(hashes, return_inverse=True)
        self.first = np.zeros(n + 1, np.int64)  # by position, 0 beyond the end
        self.first[:n] = inverse + 1
        step, bits = (3, 21) if n < (1 << 21) - 1 else (2, 31)
        rank = self.first.copy()
        self.order = np.arange(n)
        tied = np.arange(n)  # places in the order that are not settled
        width = 1
        while len(tied):
            at = self.order[tied]
            key = rank[at]
            for k in range(1, step):
                key = (key << bits) | rank[np.minimum(at + k * width, n)]
            by = np.argsort(key)
            at, key = at[by], key[by]
            self.order[tied] = at
            new = np.empty(len(at), bool)
            new[0] = True
            np.not_equal(key[1:], key[:-1], out=new[1:])
            rank[at] = tied[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))] + 1
            width *= step
            if width >= depth:
                break
            alone = new & np.append(new[1:], True)
            tied = tied[~alone]

    def _bisect(self, low: np.ndarray, high: np.ndarray, word: np.ndarray, offset: int, after: bool) -> np.ndarray:
        low, high = low.copy(), high.copy()
        last = len(self.first) - 1
        for _ in range(int((high - low).max(initial=0)).bit_length()):
            middle = (low + high) >> 1
            found = self.first[np.minimum(self.order[np.minimum(middle, last - 1)] + offset, last)]
            right = (found <= word if after else found < word) & (low < high)
            low = np.where(right, middle + 1, low)
            high = np.where(right, high, middle)
        return low

    def matches(self, test: np.ndarray, ends: np.ndarray, starts: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
        """Position, test position and length of the longest match of every test suffix at every place.

        ``ends`` has the end of each test position's item; only suffixes at ``starts`` are searched, and only
        matches of ``least`` words or more (by test position) are kept.
        """
        n = len(self.order)
        if n == 0 or len(starts) == 0:
            return (np.empty(0, np.int64),) * 3
        place = np.searchsorted(self.vocabulary, test)
        known = self.vocabulary[np.minimum(place, len(self.vocabulary) - 1)] == test
        rank = np.where(known, place + 1, -1)
        out: list[tuple[np.ndarray, ...]] = []

        def keep(low: np.ndarray, high: np.ndarray, start: np.ndarray, length: int) -> None:
            some = (high > low) & (least[start] <= length)
            low, size, start = low[some], (high - low)[some], start[some]
            out.append((self.order[ragged(low, size)], np.repeat(start, size), np.full(int(size.sum()), length)))

        start, low, high, length = starts, np.zeros(len(starts), np.int64), np.full(len(starts), n), 0
        while len(start):
            ended = (start + length >= ends[start])
            ended |= rank[np.minimum(start + length, len(rank) - 1)] < 0
            keep(low[ended], high[ended], start[ended], length)
            start, low, high = start[~ended], low[~ended], high[~ended]
            word = rank[start + length]
            left = self._bisect(low, high, word, length, False)
            right = self._bisect(left, high, word, length, True)
            keep(low, left, start, length)
            keep(right, high, start, length)
            going = right > left
            start, low, high, length = start[going], left[going], right[going], length + 1
        return tuple(np.concatenate(x).astype(np.int64) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3


class TestBlock:
    """Some benchmark items as one word sequence."""

    def __init__(self, ids: list[str], sequences: list[np.ndarray], window: int):
        sizes = np.array([len(x) for x in sequences], np.int64)
        self.ids = ids
        self.words = np.concatenate(sequences) if sequences else np.empty(0, np.uint64)
        begins = np.cumsum(sizes) - sizes
        self.item = np.repeat(np.arange(len(ids)), sizes)
        self.begins = np.repeat(begins, sizes)
        self.ends = np.repeat(begins + sizes, sizes)
        self.least = np.repeat(np.minimum(sizes, window), sizes)
        self.starts = np.flatnonzero(self.ends - np.arange(len(self.words)) >= self.least)
        self.longest = int(sizes.max(initial=0))


def _store_tests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    values = letters_and_digits()
    for batch in batches:
        hashes, at = words(*buffers(batch.column(1)), values)
        rows = [hashes[at[i] : at[i + 1]].tobytes() for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["item_id", "words"])


def store_benchmark(benchmark: DataFrame) -> str:
    """The folder with the word hashes of all items that have an id and words."""
    path = fresh_path(benchmark.sparkSession, "benchmark-words")
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    items.mapInArrow(_store_tests, "item_id string, words binary").where("length(words) > 0").write.parquet(path)
    return path


_KEPT: dict[str, list[TestBlock]] = {}


def test_blocks(path: str, window: int) -> Iterator[TestBlock]:
    """The stored benchmark in blocks of bounded size; a small one is kept in memory between slices."""
    key = f"{path} {window}"
    if key in _KEPT:
        yield from _KEPT[key]
        return
    fs, local = file_system(path)
    made, size = [], 0
    ids, sequences, held = [], [], 0
    for batch in pads.dataset(local, format="parquet", filesystem=fs, schema=pa.schema([("item_id", pa.string()), ("words", pa.binary())])).to_batches(batch_size=1024):
        for item, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(item)
            sequences.append(np.frombuffer(raw, np.uint64))
            held += len(raw) // 8
            if held >= TEST_WORDS:
                block = TestBlock(ids, sequences, window)
                ids, sequences, size, held = [], [], size + 8 * held, 0
                if size <= KEPT_TEST_BYTES:
                    made.append(block)
                yield block
    if ids:
        block = TestBlock(ids, sequences, window)
        size += 8 * held
        made.append(block)
        yield block
    if size <= KEPT_TEST_BYTES:
        _KEPT.clear()
        _KEPT[key] = made


def _scan_slice(doc_ids: list, hashes: np.ndarray, at: np.ndarray, path: str, window: int) -> list[tuple]:
    rows = len(doc_ids)
    sizes = np.diff(at)
    place = at[:-1] + np.arange(rows)  # first word of each document in the sequence with separators
    sequence = np.zeros(len(hashes) + rows, np.uint64)
    sequence[np.arange(len(hashes)) + np.repeat(np.arange(rows), sizes)] = np.where(hashes == 0, np.uint64(1), hashes)
    covered = np.zeros(len(sequence) + 1, np.int64)
    items: list[set] = [set() for _ in range(rows)]
    matches: list[list] = [[] for _ in range(rows)]
    blocks = list(test_blocks(path, window)) if f"{path} {window}" in _KEPT else None
    deepest = max((b.longest for b in (blocks if blocks is not None else test_blocks(path, window))), default=0)
    for first in range(0, len(sequence), SEGMENT_WORDS):
        suffixes = SuffixArray(sequence[first : first + SEGMENT_WORDS + deepest], deepest)
        for block in test_blocks(path, window):
            pos, test, length = suffixes.matches(block.words, block.ends, block.starts, block.least)
            own = pos < SEGMENT_WORDS
            pos, test, length = pos[own] + first, test[own], length[own]
            # A match that goes on to the left is part of a longer one.
            inner = (test > block.begins[test]) & (pos > 0) & (sequence[pos - 1] == block.words[test - 1])
            pos, test, length = pos[~inner], test[~inner], length[~inner]
            np.add.at(covered, pos, 1)
            np.add.at(covered, pos + length, -1)
            row = np.searchsorted(place, pos, side="right") - 1
            for r, p, t, n in zip(row.tolist(), (pos - place[row]).tolist(), test.tolist(), length.tolist()):
                item = block.ids[block.item[t]]
                items[r].add(item)
                matches[r].append((item, t - int(block.begins[t]), p, n))
    hit = np.cumsum(covered[:-1]) > 0
    hits = np.diff(np.append(np.cumsum(np.append(0, hit))[place], hit.sum()))
    return [
        (doc_ids[r], int(sizes[r]), int(hits[r]), len(items[r]), max((m[3] for m in matches[r]), default=0), sorted(items[r]), sorted(matches[r], key=lambda m: (m[2], m[0], m[1])))
        for r in range(rows)
    ]


SCAN_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_words", "n_hit", "n_items", "longest")]
    + [("items", pa.list_(pa.string())), ("matches", pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("doc_start", pa.int64()), ("words", pa.int64())])))]
)


def _scan(batches: Iterator[pa.RecordBatch], path: str, window: int) -> Iterator[pa.RecordBatch]:
    values = letters_and_digits()
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        doc_ids = batch.column(0).to_pylist()
        for first, last in slices(offsets):
            hashes, at = words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], values)
            rows = _scan_slice(doc_ids[first:last], hashes, at, path, window)
            names = [(*r[:6], [dict(zip(("item_id", "item_start", "doc_start", "words"), m)) for m in r[6]]) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*names), SCAN_ARROW)], schema=SCAN_ARROW)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: its words, the words inside a match, the matched items, and every longest match."""
    prepare(docs.sparkSession)
    path = store_benchmark(benchmark)
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _scan(batches, path, window), SCAN)


@tidy
def _keep_clean(batches: Iterator[pa.RecordBatch], text: int, path: str, window: int) -> Iterator[pa.RecordBatch]:
    values = letters_and_digits()
    for batch in batches:
        data, offsets = buffers(batch.column(text))
        for first, last in slices(offsets):
            hashes, at = words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], values)
            rows = _scan_slice(list(range(last - first)), hashes, at, path, window)
            clean = pa.array([r[2] == 0 for r in rows], pa.bool_())
            yield batch.slice(first, last - first).filter(clean)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without those that hold a match, all columns unchanged."""
    prepare(docs.sparkSession)
    path = store_benchmark(benchmark)
    text = docs.columns.index("text")
    return docs.mapInArrow(lambda batches: _keep_clean(batches, text, path, window), docs.schema)


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "longest",
    )
