"""Alignment of two tokenizers over the same bytes, and the most usual partner of every token.

Tokenizer A is a byte-level BPE and reads a space and the text; B is a sentence-piece model, which adds that space itself. Both
lists of tokens tile the same bytes, so every token is an interval.

Interval coalescing, for many texts at once on one byte axis: all intervals of A and B are sorted by their start
(``lexsort``); where a start reaches the running maximum of the ends before it (``maximum.accumulate``), both tokenizers have
ended a token and a new group begins. Within a group each A token expands to the B tokens that overlap it: those are its links.

How many texts hold an id pair linked is counted over the whole table:

1. Texts are encoded and aligned once. Each keeps its distinct linked pairs and how often each occurs, written to the shared folder.
2. Pairs are counted per task and then by pair; the highest count of each A id is a table no longer than the vocabulary.
3. The counts of at most ``shipped`` pairs, the most frequent ones, go to all tasks, which add them up for their texts. Links
   of further pairs, if there are any, meet their counts in a shuffled join. Both ways are exact.

Fast path: texts of ASCII and Latin-1 letters alone are encoded for A by another library with the same vocabulary and
pattern; all others by the tokenizer itself. Tests hold both against each other.

Rows: NULL and empty texts have no tokens, nor have texts whose tokens do not give back their bytes (a sentence-piece
model may rewrite or lose some); such rows have zeros and an empty digest. Repeated rows, and rows that share a doc_id
or have none, are texts of their own, each counted. Further columns are ignored. Memory in a task follows the longest text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import buffers, prepare, ragged, slices, staged
from rosterline.session import fresh_path

SLICE = 1 << 20
SHIPPED_PAIRS = 1 << 20
COUNTED_AT_ONCE = 1 << 23
STEPS_PER_DOUBLING = 8

# The bytes that a byte-level alphabet shows as themselves, and the pattern by which it cuts text.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
WORD_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

USUAL = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"


def byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level alphabet stands for."""
    hidden = [b for b in range(256) if b not in SHOWN]
    return {chr(b): b for b in SHOWN} | {chr(256 + k): b for k, b in enumerate(hidden)}


class _Pool:
    """Byte strings by id."""

    def __init__(self, entries: list[bytes]):
        self.lengths = np.fromiter(map(len, entries), np.int64, len(entries))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.starts[ids], self.lengths[ids])]


class Aligner:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, file_a: str, file_b: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        signs = byte_of_sign()
        entries = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, number in self.a.get_vocab(with_added_tokens=True).items():
            known = all(c in signs for c in token)
            entries[number] = bytes(signs[c] for c in token) if known else token.encode()
        self.pool_a = _Pool(entries)
        self.size_b = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(k) for k in range(self.size_b)]
        self.pool_b = _Pool([bytes([int(p[3:-1], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)])
        plain = self.a.get_vocab(with_added_tokens=False)
        ranks = {entries[number]: number for number in plain.values()}
        settings = json.loads(self.a.to_str())
        steps = settings.get("pre_tokenizer") or {}
        usual = settings.get("normalizer") is None and steps.get("type") == "ByteLevel" and steps.get("use_regex") and not steps.get("add_prefix_space")
        whole = len(ranks) == len(plain) and all(bytes([k]) in ranks for k in range(256))
        self.fast = tiktoken.Encoding("a", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={}) if usual and whole else None
        self.names = pa.array([f"{k}{sign}" for k in range(max(len(entries), self.size_b)) for sign in ",|;"])

    def ids_a(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        found: list = [None] * len(texts)
        slow = []
        for k, text in enumerate(texts):
            if self.fast is not None and USUAL.fullmatch(text):
                found[k] = self.fast.encode_to_numpy(text, disallowed_special=()) if text else np.empty(0, np.uint32)
            else:
                slow.append(k)
        if slow:
            for k, made in zip(slow, self.a.encode_batch([texts[k] for k in slow], add_special_tokens=False)):
                found[k] = np.array(made.ids, np.uint32)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.concatenate([np.empty(0, np.uint32), *found]).astype(np.int64), sizes

    def ids_b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.b.encode(text, return_type="numpy") for text in texts]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.concatenate([np.empty(0, np.int32), *found]).astype(np.int64), sizes

    def align(self, texts: list[str], data: np.ndarray, offsets: np.ndarray) -> list[tuple]:
        """For every text of a slice: n_a, n_b, n_groups, n_links, digest, packed pairs. ``data`` holds the texts' bytes."""
        ids_a, n_a = self.ids_a([" " + t if t else "" for t in texts])
        ids_b, n_b = self.ids_b(texts)
        expected = np.diff(offsets) + 1
        whole = np.diff(offsets) > 0
        for ids, sizes, pool in ((ids_a, n_a, self.pool_a), (ids_b, n_b, self.pool_b)):
            whole &= self._gives_back(ids, sizes, pool, data, offsets, expected)
        ids_a, ids_b = ids_a[np.repeat(whole, n_a)], ids_b[np.repeat(whole, n_b)]
        n_a, n_b = np.where(whole, n_a, 0), np.where(whole, n_b, 0)
        found = self._groups_and_links(ids_a, ids_b, n_a, n_b, np.where(whole, expected, 0))
        return list(zip(n_a.tolist(), n_b.tolist(), *found))

    @staticmethod
    def _gives_back(ids, sizes, pool, data, offsets, expected) -> np.ndarray:
        """Whether the tokens of a text join to a space and its bytes."""
        count = len(sizes)
        first = np.append(0, np.cumsum(sizes))
        total = np.append(0, np.cumsum(pool.lengths[ids]))[first]
        fits = (np.diff(total) == expected) & (sizes > 0)
        joined = pool.joined(ids[np.repeat(fits, sizes)])
        wanted = np.full(int(expected[fits].sum()), 32, np.uint8)
        rows = np.flatnonzero(fits)
        begin = np.cumsum(expected[rows]) - expected[rows]
        wanted[ragged(begin + 1, expected[rows] - 1)] = data[ragged(offsets[:-1][rows], expected[rows] - 1)]
        differs = np.append(0, np.cumsum(joined != wanted))
        out = np.zeros(count, bool)
        out[rows] = differs[begin + expected[rows]] == differs[begin]
        return out

    def _groups_and_links(self, ids_a, ids_b, n_a, n_b, sizes) -> tuple[list, ...]:
        texts, count_a, count_b = len(sizes), len(ids_a), len(ids_b)
        text_end = np.cumsum(sizes)
        end_a, end_b = np.cumsum(self.pool_a.lengths[ids_a]), np.cumsum(self.pool_b.lengths[ids_b])
        start_a, start_b = end_a - self.pool_a.lengths[ids_a], end_b - self.pool_b.lengths[ids_b]

        start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
        order = np.lexsort((np.repeat([0, 1], [count_a, count_b]), start))
        reach = np.maximum.accumulate(end[order])
        breaks = np.append(True, start[order][1:] >= reach[:-1])[: len(order)]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(breaks) - 1
        group_a, group_b = group[:count_a], group[count_a:]
        groups = int(breaks.sum())
        n_groups = np.bincount(np.searchsorted(text_end, start[order][breaks], side="right"), minlength=texts)

        low, high = np.searchsorted(end_b, start_a, side="right"), np.searchsorted(start_b, end_a, side="left")
        partners = high - low
        text_a = np.repeat(np.arange(texts), n_a)
        n_links = np.bincount(text_a, partners, texts).astype(np.int64)
        code = np.repeat(ids_a, partners) * self.size_b + ids_b[ragged(low, partners)]
        distinct, times = np.unique((np.repeat(text_a, partners) << 32) | code, return_counts=True)
        bounds = np.searchsorted(distinct >> 32, np.arange(texts + 1))
        packed = [pack(distinct[i:j] & 0xFFFFFFFF, times[i:j]) for i, j in zip(bounds[:-1], bounds[1:])]

        # Tokens group by group, A before B, each with the sign after it; a group's place follows from counts alone.
        of_a, of_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        place_a = np.arange(count_a) + (np.cumsum(of_b) - of_b)[group_a]
        place_b = np.arange(count_b) + np.cumsum(of_a)[group_b]
        name = np.empty(count_a + count_b, np.int64)
        name[place_a] = ids_a * 3 + np.append(group_a[1:] != group_a[:-1], True)[:count_a]
        name[place_b] = ids_b * 3 + 2 * np.append(group_b[1:] != group_b[:-1], True)[:count_b]
        listed, at = buffers(self.names.take(pa.array(name)))
        edge = np.append(0, np.cumsum(n_a + n_b))
        listed = memoryview(np.ascontiguousarray(listed))
        digests = [hashlib.sha256(listed[at[i] : at[j] - 1]).hexdigest() if j > i else "" for i, j in zip(edge[:-1].tolist(), edge[1:].tolist())]
        return n_groups.tolist(), n_links.tolist(), digests, packed


def pack(codes: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending pair codes as differences, and how often each occurs, byte plane by byte plane (which compresses well)."""
    planes = np.stack([np.diff(codes, prepend=0), times]).astype("<u4").view(np.uint8).reshape(2, -1, 4)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).tobytes()


def unpack(data) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(2, 4, -1)
    gaps, times = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4")[:, :, 0].astype(np.int64)
    return np.cumsum(gaps), times


@cache
def aligner(file_a: str, file_b: str) -> Aligner:
    """One for each worker process; its size is that of the vocabularies."""
    return Aligner(file_a, file_b)


def align(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """One row per document with its counts, digest and packed distinct pairs (code: A id times the size of B, plus B id)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(file_a, file_b)
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for first, last in slices(offsets, SLICE):
                texts = [t or "" for t in batch.column(1).slice(first, last - first).to_pylist()]
                found = tool.align(texts, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                columns = [pa.array(c, t) for c, t in zip(zip(*found), [pa.int64()] * 4 + [pa.string(), pa.binary()])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), *columns], [c.split()[0] for c in ALIGNED.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(rows, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, texts): how many rows hold each pair."""

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        pairs, texts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(texts)], ["pair", "texts"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for data in batch.column(0):
                held.append(unpack(data.as_buffer())[0].astype(np.uint32))
                size += len(held[-1])
                if size >= COUNTED_AT_ONCE:
                    yield counted(held)
                    held, size = [], 0
        if size:
            yield counted(held)

    parts = aligned.select("pairs").mapInArrow(rows, "pair long, texts long")
    return parts.groupBy("pair").agg(F.sum("texts").alias("texts"))


def _most_frequent(counts: DataFrame, shipped: int) -> tuple[DataFrame, int, int]:
    """The pairs with at least so many texts that no more than ``shipped`` are chosen; how many, and how many are left."""
    step = F.floor(F.log2(F.col("texts").cast("double")) * STEPS_PER_DOUBLING).cast("int")
    sizes = {r["step"]: r["pairs"] for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs")).collect()}  # a few hundred rows
    least, chosen = max(sizes, default=0) + 1, 0
    for level in sorted(sizes, reverse=True):
        if chosen + sizes[level] > shipped:
            break
        least, chosen = level, chosen + sizes[level]
    return counts.where(step >= least), chosen, sum(sizes.values()) - chosen


def align_and_count(docs: DataFrame, file_a: str, file_b: str, shipped: int = SHIPPED_PAIRS) -> DataFrame:
    """The rows of ``align`` without their pairs, with ``n_best`` and ``count_sum`` over their links."""
    spark = prepare(docs.sparkSession)
    tool = aligner(file_a, file_b)
    size_a, size_b = len(tool.pool_a.lengths), tool.size_b
    path = fresh_path(spark, "aligned")
    align(docs, file_a, file_b).withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    aligned = spark.read.schema(f"{ALIGNED}, row long").parquet(path)

    counts = staged(pair_counts(aligned), "pair-counts")
    a_of = F.floor(F.col("pair") / size_b).cast("long")
    highest = np.zeros(size_a, np.int64)
    for r in counts.groupBy(a_of.alias("a")).agg(F.max("texts").alias("texts")).toLocalIterator():  # the vocabulary at most
        highest[r["a"]] = r["texts"]
    frequent, _, left = _most_frequent(counts, shipped)
    known = frequent.toArrow()
    order = np.argsort(known.column("pair").to_numpy())
    known = (known.column("pair").to_numpy()[order].astype(np.uint32), known.column("texts").to_numpy()[order])
    shared = spark.sparkContext.broadcast((highest, *known))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        highest, pairs, texts = shared.value
        best = texts == highest[pairs // size_b] if len(pairs) else np.empty(0, bool)
        for batch in batches:
            n_best, count_sum, rest_pairs, rest_times = [], [], [], []
            for data in batch.column(1):
                code, times = unpack(data.as_buffer())
                place = np.searchsorted(pairs, code.astype(np.uint32))
                hit = np.zeros(len(code), bool)
                inside = place < len(pairs)
                hit[inside] = pairs[place[inside]] == code[inside]
                n_best.append(int(times[hit][best[place[hit]]].sum()))
                count_sum.append(int((times[hit] * texts[place[hit]]).sum()))
                rest_pairs.append(code[~hit])
                rest_times.append(times[~hit])
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (rest_pairs, rest_times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), *lists], ["row", "n_best", "count_sum", "rest_pairs", "rest_times"])

    summed = aligned.select("row", "pairs").mapInArrow(rows, "row long, n_best long, count_sum long, rest_pairs array<long>, rest_times array<long>")
    per_row = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    summed = staged(summed, "alignment-sums")
    if left:
        links = summed.select("row", F.explode(F.arrays_zip("rest_pairs", "rest_times")).alias("link")).select("row", F.col("link.rest_pairs").alias("pair"), F.col("link.rest_times").alias("times"))
        top = F.broadcast(spark.createDataFrame(pa.table({"a": np.arange(size_a), "highest": highest})))
        judged = links.join(counts, "pair").join(top, a_of == F.col("a"))
        hits = F.when(F.col("texts") == F.col("highest"), F.col("times")).otherwise(0)
        rest = judged.groupBy("row").agg(F.sum(hits).alias("n_best"), F.sum(F.col("times") * F.col("texts")).alias("count_sum"))
        summed = summed.select("row", "n_best", "count_sum").unionByName(rest)
        summed = summed.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return aligned.select(*per_row).join(summed.select("row", "n_best", "count_sum"), "row").drop("row")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = align_and_count(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
