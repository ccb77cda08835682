"""Exact Jaccard join on word shingles by PartEnum signatures.

A document's set holds the hashes of its distinct 5-word shingles. Two sets with a similarity of 0.8 or more differ
in at most k = (|a| + |b|) / 9 shingles, and the larger has at most 1.25 times the size of the smaller. Sizes fall into bands
whose lower ends grow by the root of two and which reach to 1.25 times their last size, so such a pair shares the band of the
smaller set. Each band cuts the shingle domain by hash into n1 partitions of n2 cells (``cut``). A signature is the content
of all cells of a partition but k2:

* bands from ``SUBSETS_FROM`` to ``WHOLE_FROM`` shingles: subsets of two of three cells (n2 = 3, k2 = 1). A differing shingle spoils
  two of a partition's three signatures, a second one in another cell the third, so k of them spoil at most ``spoiled`` ones;
* larger bands: whole partitions (n2 = 1, k2 = 0), each spoiled by one differing shingle. Only those of at least two shingles
  count, so a single shingle that many documents have in common makes no signature;
* smaller bands: every shingle is a signature.

A set that has more signatures than can be spoiled shares one with every similar set. One that has not (chance put its
shingles into too few cells) signs every partition that holds a shingle, and every shingle too if these are too few as well.

Links are found without emitting all pairs of a group:

1. Sets that are equal are one class; one member stands for it.
2. Signatures are folded to counts in each task, packed by ranges of hashes and added up range by range, so a hot one
   is one entry of each fold. Of the stored signatures a bitmap of fixed size then lets
   through those that may be shared; a join with the counts, which adaptive execution may cut, makes that exact.
3. Of its signatures each document keeps as many as can be spoiled and one more, the rarest by one global order: the rarest one that
   a similar pair has in common is among those of both. So passages that many documents share, and the common part
   of a large group of copies, do not bring documents together that differ in enough rare places.
4. In each bucket every document is compared with the first one, then, in buckets that still hold several components, with
   the last one. Only buckets that after that still hold several components give pairs, those of different components
   whose sizes and 512-bit parities allow a link.

Comparison is exact, on whole sets. Before sets are fetched, pairs meet on parity bitmaps of two to four bits a
shingle: a differing shingle flips one bit, so bitmaps that differ in more than k bits rule a pair out and no similar
pair is lost. Texts are not shuffled: a bitmap of ``FILTER_BITS`` document slots, of fixed size, tells the scan
which documents are wanted, and an exact join follows.

Rows: NULL and blank texts have an empty set and are linked with nothing; rows that repeat a doc_id and set count
once; a doc_id with several texts is one document whose links are those of each text, with a row for each; rows
without doc_id are reported with a NULL component and linked with nothing; further columns do not matter.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterline.llm.common import buffers, discard, mix, not_blank, prepare, prompt_cleanup, slices, staged, tidy, windows, words
from rosterline.llm.components import components

SHINGLE = 5
SKETCH = 8  # 64-bit words
FILTER_BITS = 23
SIGNED_BITS = 26
# Bytes of text that a task hashes at once.
SLICE_BYTES = 1 << 18
# Signatures that a task folds at once, and about how many a range of hashes holds; the number of ranges follows the table.
FOLDED_AT_ONCE, RANGE_ENTRIES = 1 << 19, 1 << 16
# Lower ends of the bands from which on signatures are subsets of cells, and whole partitions.
SUBSETS_FROM, WHOLE_FROM = 8, 256
# Partitions for one shingle that the largest set of a band may differ in; they leave sets of all its sizes about a sixth to spare.
SUBSETS_FILL, WHOLE_FILL = 1.5, 1.65

SETS = "doc_id long, n_shingles long, key_a long, key_b long, parity binary, sketch array<long>, signatures binary, spare int"
SIGNATURES = "sig long, doc_id long, spare int"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, values: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a slice."""
    hashes, at = words(data, offsets, values)
    runs = windows(hashes, SHINGLE)
    for first, last in zip(at[:-1].tolist(), at[1:].tolist()):
        if last - first >= SHINGLE:
            yield np.unique(runs[first : last - SHINGLE + 1])
        elif last > first:
            yield windows(np.append(hashes[first:last], np.uint64(last - first)), last - first + 1)
        else:
            yield np.empty(0, np.uint64)


@functools.cache
def lower_end(band: int) -> int:
    """The smallest size of a band: powers of the root of two, rounded."""
    return math.isqrt(1 << band) if band % 2 == 0 else round(math.sqrt(2) * (1 << band // 2))


def bands(size: int) -> list[int]:
    """The bands that a set of this size belongs to, its own first."""
    own = 2 * (size.bit_length() - 1)
    own += lower_end(own + 1) <= size
    while own and lower_end(own) == lower_end(own - 1):
        own -= 1
    return [own, *(b for b in range(max(own - 2, 0), own) if lower_end(b) < lower_end(b + 1) and 4 * size <= 5 * (lower_end(b + 1) - 1))]


def largest_difference(size: int) -> int:
    """The most shingles in which a set of this size and a similar one that is no smaller can differ."""
    return (size + size * 5 // 4) // 9


@functools.cache
def cut(band: int) -> tuple[int, int]:
    """Partitions of a band and cells of each; (0, 0) where every shingle is a signature."""
    low = lower_end(band)
    most = largest_difference(5 * (lower_end(band + 1) - 1) // 4)
    if low < SUBSETS_FROM:
        return 0, 0
    if low < WHOLE_FROM:
        return math.ceil(SUBSETS_FILL * (most // 2 + 1)), 3
    return math.ceil(WHOLE_FILL * most), 1


def spoiled(size: int, partitions: int, cells: int) -> int:
    """The most signatures that the differing shingles of a similar pair can spoil for a set of this size."""
    k = largest_difference(size)
    if cells == 1:
        return min(k, partitions)
    return 2 * min(k, partitions) + min(max(k - partitions, 0), partitions)


def _subsets(shingles: np.ndarray, place: np.ndarray, salt: np.uint64, partitions: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of all subsets that hold a shingle, and how many shingles each holds."""
    cell = (place % np.uint64(partitions * cells)).astype(np.int64)
    order = np.argsort(cell.astype(np.uint16) if partitions * cells <= 1 << 16 else cell, kind="stable")  # short keys sort by radix
    held = np.bincount(cell, minlength=partitions * cells)
    total = np.append(np.uint64(0), np.cumsum(mix(shingles[order] + salt)))
    upto = np.append(0, np.cumsum(held))
    content = (total[upto[1:]] - total[upto[:-1]]).reshape(partitions, cells)
    held = held.reshape(partitions, cells)
    if cells > 1:  # all cells but one
        content = content.sum(axis=1, dtype=np.uint64)[:, None] - content
        held = held.sum(axis=1)[:, None] - held
    number = np.arange(partitions * cells, dtype=np.uint64)
    return mix(mix(content.ravel()) ^ mix(number + salt))[held.ravel() > 0], held.ravel()[held.ravel() > 0]


def signed_and_spare(shingles: np.ndarray, band: int) -> tuple[np.ndarray, int]:
    """Signatures of a set in a band, and how many of them are more than it needs.

    A set that has too few signs more than sets that have enough, and so keeps all of them.
    """
    salt = np.uint64((band + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    place = mix(shingles ^ salt)
    partitions, cells = cut(band)
    if partitions == 0:
        return mix(place + salt), len(shingles) - largest_difference(len(shingles)) - 1
    found, held = _subsets(shingles, place, salt, partitions, cells)
    need = spoiled(len(shingles), partitions, cells) + 1
    usual = found[held >= 2] if cells == 1 else found
    if len(usual) >= need:
        return usual, len(usual) - need
    return (found if len(found) >= need else np.append(found, mix(place + salt))), 0


def signatures(shingles: np.ndarray, band: int) -> np.ndarray:
    return signed_and_spare(shingles, band)[0]


def parity(shingles: np.ndarray) -> bytes:
    """One bit for every slot of a domain of two to four slots a shingle: whether an odd number fell there."""
    bits = 64 << max(0, len(shingles).bit_length() - 5)
    return np.packbits(np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1, bitorder="little").tobytes()


def parity_distance(a: bytes, b: bytes) -> int:
    """Differing bits after the longer bitmap is folded to the length of the shorter one."""
    x, y, size, target = int.from_bytes(a, "little"), int.from_bytes(b, "little"), max(len(a), len(b)), min(len(a), len(b))
    if len(a) < len(b):
        x, y = y, x
    while size > target:
        size //= 2
        x = (x >> (8 * size)) ^ (x & ((1 << (8 * size)) - 1))
    return (x ^ y).bit_count()


@tidy
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text; the first of equal sets in a task carries the signatures of all its bands."""
    values = not_blank()
    seen: set[bytes] = set()
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        for first, last in slices(offsets, SLICE_BYTES):
            size, key_a, key_b, spare = (np.zeros(last - first, np.int64) for _ in range(4))
            bits, signed = [], []
            sketch = np.zeros((last - first, SKETCH), np.int64)
            part = shingle_sets(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], values)
            for row, found in enumerate(part):
                size[row] = len(found)
                bits.append(parity(found))
                sketch[row] = np.packbits(np.bincount((found & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1, bitorder="little").view(np.int64)
                key_a[row] = mix(found).sum(dtype=np.uint64).astype(np.int64)
                key_b[row] = np.bitwise_xor.reduce(mix(found ^ np.uint64(0xA5A5A5A5A5A5A5A5)), initial=np.uint64(0)).astype(np.int64)
                key = size[row].tobytes() + key_a[row].tobytes() + key_b[row].tobytes()
                if len(found) == 0 or key in seen:
                    signed.append(None)
                    continue
                seen.add(key)
                in_bands, spares = zip(*(signed_and_spare(found, band) for band in bands(len(found))))
                signed.append(np.concatenate(in_bands).tobytes())
                spare[row] = min(spares)
            sketches = pa.ListArray.from_arrays(pa.array(np.arange(0, sketch.size + 1, SKETCH, dtype=np.int32)), pa.array(sketch.ravel()))
            columns = [batch.column(0).slice(first, last - first), pa.array(size), pa.array(key_a), pa.array(key_b), pa.array(bits, pa.binary()), sketches, pa.array(signed, pa.binary()), pa.array(spare.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SETS.split(", ")])


@tidy
def _unpacked(batches: Iterator[pa.RecordBatch], shared: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Stored signatures as rows; with a bitmap only those that it says may be shared."""
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        sig, counts = data.view(np.uint64), np.diff(offsets) // 8
        doc_id, spare = (np.repeat(batch.column(i).to_numpy(zero_copy_only=False), counts) for i in (0, 2))
        if shared is not None:
            slot = sig & np.uint64((1 << SIGNED_BITS) - 1)
            some = (shared[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
            sig, doc_id, spare = sig[some], doc_id[some], spare[some]
        yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(doc_id), pa.array(spare)], ["sig", "doc_id", "spare"])


def _counted(sigs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct signatures, ascending, with the sums of their counts."""
    every = np.concatenate(sigs)
    order = np.argsort(every)
    every = every[order]
    begin = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.empty(0, np.int64)
    return every[begin], np.add.reduceat(np.concatenate(counts)[order], begin) if len(every) else np.empty(0, np.int64)


@tidy
def _packed_counts(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Stored signatures, folded and packed by the range of hashes they fall into."""

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        sigs, counts = _counted(held, [np.ones(len(x), np.int64) for x in held])
        edges = np.searchsorted(sigs >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        some = np.flatnonzero(np.diff(edges))
        parts = [(sigs[i:j].tobytes(), counts[i:j].astype(np.uint32).tobytes()) for i, j in zip(edges[some].tolist(), edges[some + 1].tolist())]
        return pa.RecordBatch.from_arrays([pa.array(some), pa.array([p[0] for p in parts], pa.binary()), pa.array([p[1] for p in parts], pa.binary())], ["range", "sigs", "counts"])

    held, size = [], 0
    for batch in batches:
        data, _ = buffers(batch.column(0))
        held.append(data.view(np.uint64).copy())
        size += len(held[-1])
        if size >= FOLDED_AT_ONCE:
            yield packed(held)
            held, size = [], 0
    if size:
        yield packed(held)


@tidy
def _shared_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures of several documents, with their number; rows of a range follow one another."""

    def shared(sigs: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        found, size = _counted(sigs, counts)
        return pa.RecordBatch.from_arrays([pa.array(found[size > 1].view(np.int64)), pa.array(size[size > 1])], ["sig", "size"])

    now, sigs, counts, held = None, [], [], 0
    for batch in batches:
        for part, sig, count in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            if part != now and sigs or held >= FOLDED_AT_ONCE:
                if part != now:
                    yield shared(sigs, counts)
                    sigs, counts, held = [], [], 0
                else:
                    folded = _counted(sigs, counts)
                    sigs, counts, held = [folded[0]], [folded[1]], 0
            now = part
            sigs.append(np.frombuffer(sig.as_buffer(), np.uint64))
            counts.append(np.frombuffer(count.as_buffer(), np.uint32).astype(np.int64))
            held += len(sigs[-1])
    if sigs:
        yield shared(sigs, counts)


@tidy
def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    values = not_blank()
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        for first, last in slices(offsets, SLICE_BYTES):
            found = list(shingle_sets(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], values))
            bounds = np.append(0, np.cumsum([len(x) for x in found])).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(found).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), lists], ["doc_id", "shingles"])


@tidy
def _near_by_parity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size_a, size_b, bits_a, bits_b = (batch.column(i).to_pylist() for i in range(2, 6))
        near = [parity_distance(x, y) <= (m + n) // 9 for m, n, x, y in zip(size_a, size_b, bits_a, bits_b)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(near, pa.bool_()))


def _bitmap(slots: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the slots (long, below 2 ** bits); of fixed size whatever the rows."""
    word = F.shiftright("slot", 6).alias("word")
    found = slots.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits")).toArrow()
    out = np.zeros((1 << bits) // 64, np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _slot(column: str) -> F.Column:
    return F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS)).cast("long")


class _Join:
    """The steps of one join over (doc_id, text) rows with ids."""

    def __init__(self, docs: DataFrame):
        self.docs = docs
        self.signed = staged(docs.mapInArrow(_sets, SETS), "signed-sets")
        self.all_sets = staged(self.signed.drop("signatures", "spare"), "shingle-sets")
        self.sets = self.all_sets.select("doc_id", "n_shingles", "key_a", "key_b").distinct()
        some = self.all_sets.where("n_shingles > 0").select("doc_id", "n_shingles", "key_a", "key_b", "sketch").distinct()
        first = some.groupBy("n_shingles", "key_a", "key_b").agg(F.min("doc_id").alias("member"))
        # A doc_id with several texts has one member for each; its own links join them.
        self.members = staged(some.join(first, ["n_shingles", "key_a", "key_b"]).select("doc_id", "member", "n_shingles", "sketch"), "set-members")
        self.links = None
        self.tested = None
        # Links to the first document of each component so far; new links are added to these.
        self.stars = self.members.where("doc_id <> member").select(F.col("doc_id").alias("a"), F.col("member").alias("b"))

    def wanted(self, ids: DataFrame) -> DataFrame:
        """The shingles of the documents that may have one of these ids, by a filter of fixed size."""
        bits = _bitmap(ids.select(_slot("doc_id").alias("slot")), FILTER_BITS)
        shared = self.docs.sparkSession.sparkContext.broadcast(bits)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                slot = batch.column(2).to_numpy()
                keep = (shared.value[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)
                yield batch.select([0, 1]).filter(pa.array(keep.astype(bool)))

        # One Python worker does both steps.
        return self.docs.select("doc_id", "text", _slot("doc_id").alias("slot")).mapInArrow(lambda batches: _shingles(rows(batches)), "doc_id long, shingles array<long>")

    def buckets(self) -> DataFrame:
        """(sig, doc_id, first, last): signatures that several documents keep, with the first and the last of these."""
        spark = self.docs.sparkSession
        signed = self.signed.select("doc_id", "signatures", "spare").where("signatures IS NOT NULL")
        shingles = self.all_sets.agg(F.sum("n_shingles")).first()[0] or 0
        bits = max(6, (int(shingles) // RANGE_ENTRIES).bit_length())
        packed = signed.select("signatures").mapInArrow(lambda batches: _packed_counts(batches, bits), "range long, sigs binary, counts binary")
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(shingles) // FOLDED_AT_ONCE)
        counts = staged(packed.repartition(tasks, "range").sortWithinPartitions("range").mapInArrow(_shared_counts, "sig long, size long"), "signature-counts")
        may = spark.sparkContext.broadcast(_bitmap(counts.select(F.col("sig").bitwiseAND(F.lit((1 << SIGNED_BITS) - 1)).alias("slot")), SIGNED_BITS))
        again = signed.mapInArrow(lambda batches: _unpacked(batches, may.value), SIGNATURES)
        # Signatures of one document alone are its rarest; so it may drop as many of the others as it has to spare.
        rarest_last = Window.partitionBy("doc_id").orderBy(F.desc("size"), F.desc("sig"))
        ranked = again.join(counts, "sig").withColumn("place", F.row_number().over(rarest_last))
        kept = staged(ranked.where("place > spare").select("sig", "doc_id"), "signatures")
        discard(self.signed, counts)
        may.destroy()
        ends = kept.groupBy("sig").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
        buckets = staged(kept.join(ends, "sig"), "buckets")
        discard(kept)
        return buckets

    def verify(self, pairs: DataFrame) -> None:
        """Compare pairs (a, b) that were not compared before, on whole sets, and add the links."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        self.tested = pairs if self.tested is None else self.tested.union(pairs)
        bits = self.all_sets.select("doc_id", F.col("n_shingles").alias("n"), "parity").dropDuplicates(["doc_id", "n", "parity"])
        left, right = bits.toDF("a", "n_a", "bits_a"), bits.toDF("b", "n_b", "bits_b")
        size = F.col("n_a") * 5 >= F.col("n_b") * 4
        near = pairs.join(left, "a").join(right, "b").where(size & (F.col("n_b") * 5 >= F.col("n_a") * 4))
        near = near.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(_near_by_parity, "a long, b long").distinct()
        near = staged(near, "near-pairs")
        needed = near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct()
        sets = self.wanted(needed).join(needed, "doc_id", "left_semi")
        sets = staged(sets, "shingles")
        left, right = sets.toDF("a", "of_a"), sets.toDF("b", "of_b")
        size_a, size_b = F.size("of_a").cast("long"), F.size("of_b").cast("long")
        found = near.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("of_a", "of_b")).cast("long"))
        links = staged(found.where(F.col("common") * 100 >= (size_a + size_b - F.col("common")) * 80).select("a", "b").distinct(), "verified")
        discard(near, sets)
        self.links = links if self.links is None else self.links.union(links)
        self.stars = components(self.stars.union(links)).toDF("a", "b")

    def labels(self) -> DataFrame:
        """Every document with a set, its size and its component so far."""
        sizes = self.members.select("doc_id", "n_shingles", "sketch").join(self.stars.toDF("doc_id", "component"), "doc_id", "left")
        return staged(sizes.withColumn("component", F.coalesce("component", "doc_id")), "components")

    def still_open(self, buckets: DataFrame, labels: DataFrame) -> DataFrame:
        """The rows of buckets that hold several components."""
        known = buckets.join(labels.select("doc_id", "component").distinct(), "doc_id")
        several = known.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
        return staged(known.join(several.select("sig"), "sig", "left_semi").select("sig", "doc_id", "first", "last"), "open-buckets")

    def open_pairs(self, buckets: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs within a bucket whose components differ and whose sizes and parities allow a link."""
        known = staged(buckets.select("sig", "doc_id").join(labels, "doc_id").select("sig", "doc_id", "component", "n_shingles", "sketch"), "open-members")
        left, right = known.toDF("sig", "a", "component_a", "n_a", "sketch_a"), known.toDF("sig", "b", "component_b", "n_b", "sketch_b")
        differing = " + ".join(f"bit_count(sketch_a[{i}] ^ sketch_b[{i}])" for i in range(SKETCH))
        near = f"a < b AND component_a <> component_b AND n_a * 5 >= n_b * 4 AND n_b * 5 >= n_a * 4 AND ({differing}) * 9 <= n_a + n_b"
        return left.join(right, ["sig"]).where(near).select("a", "b").distinct()


def link(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All documents with their set and component, and the verified links between members of classes."""
    spark = prepare(docs.sparkSession)
    known = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    with prompt_cleanup(spark):
        join = _Join(known)
        buckets = join.buckets()
        for centre in ("first", "last"):
            join.verify(buckets.select(F.col(centre).alias("a"), F.col("doc_id").alias("b")))
            labels = join.labels()
            narrowed = join.still_open(buckets, labels)
            discard(buckets)
            buckets = narrowed
        join.verify(join.open_pairs(buckets, labels))
        discard(buckets)
        labels = join.labels()

    labels = labels.select("doc_id", F.col("component").alias("component_id")).distinct()
    unknown = docs.where("doc_id IS NULL").select("doc_id", "text").mapInArrow(_sets, SETS).withColumn("component_id", F.lit(None).cast("long"))
    found = join.sets.join(labels, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return found.unionByName(unknown.drop("parity", "sketch", "signatures", "spare")).drop("key_a", "key_b"), join.links


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest doc_id; all columns unchanged.

    Rows without doc_id stay; of rows that repeat a doc_id all or none stay.
    """
    found, _ = link(docs)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = link(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_shingles", "component_id")
