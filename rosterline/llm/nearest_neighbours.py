"""Approximate nearest neighbours by cosine over several shifted Hilbert orderings.

Every vector is scaled to length 1 and projected, once for each of ``ORDERINGS`` random rotations, on ``AXES`` axes; the
projections are shifted by a random amount, cut into 2 ** ``BITS`` cells an axis, and the cells' Hilbert keys put the
vectors in an order. Keys are dealt by ranges of about ``RANGE`` keys, packed, and sorted, which gives every vector its exact
rank in each ordering. A query's candidates are the vectors whose ranks lie within half a window of its own, exactly, in one
ordering or more; a candidate that several orderings name counts once, and candidates are ranked by their exact cosine in double precision.

A window is the larger of ``LEAST_WINDOW`` and ``WINDOW_SHARE`` of the vectors. Neighbours in high-dimensional data without
structure are hardly nearer than the rest, so the share, not a fixed number, keeps the recall at every size; README gives the
measured recall and share of the table met.

The candidates of all queries grow with the square of the vectors, so they are met where they are scored and never stored. Vectors and
their ranks lie in the shared folder by segments of at most ``SEGMENT`` places (a place is an entry's number). A task holds up to
``CHUNK`` queries and reads segment after segment, a block of ``BLOCK`` vectors at a time. As windows name about half of
the vectors, one matrix product over a block in single precision costs less than picking them out. Of a block only the pairs whose product,
with its error bound, could reach the best candidates so far are looked at; of these the windows keep the candidates, and those get
their exact cosine. What is kept of a query is its ``k`` + 1 best, so memory and disk do not follow the candidates.

Equal vectors are one entry with the ``k`` + 1 smallest ids, which is all that any answer can use, so a vector that
a third of the rows share takes one place in each ordering. Axes are scaled by a sample of ``FIT_ROWS`` entries; it only
affects where cells lie and where ranges of keys end, never which vectors are indexed.

Rows: vectors that are NULL, zero, of NULL or non-finite components, or of another length than most take no part; nor
do rows without id; rows that repeat an id are never each other's neighbour, and such an id asks with one of its vectors; ties go to the smaller id; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.llm.common import discard, file_system, prepare, prompt_cleanup, ragged, staged, tidy
from rosterline.session import fresh_path

ORDERINGS = 40
AXES, BITS = 16, 4
WINDOW_SHARE, LEAST_WINDOW = 1 / 52, 32
BLOCK, CHUNK, SEGMENT = 256, 1 << 14, 1 << 16  # places of a segment are told apart by two bytes
RANGE, PACKED, ROUND = 1 << 19, 1 << 15, 20
QUERY_BYTES, QUERY_TILE = 1 << 25, 2048
FIT_ROWS = 4096
SEED = 20040426


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of rows of cell numbers of up to 8 bits, by Skilling's transposition (2004)."""
    x = cells.astype(np.uint8).T.copy()
    axes, one = len(x), np.uint8(1)
    for level in range(bits - 1, 0, -1):
        low = np.uint8((1 << level) - 1)
        for axis in range(axes):
            kept = ((x[axis] >> np.uint8(level)) & one) - one  # all bits where the level's bit is not set
            swap = (x[0] ^ x[axis]) & (kept & low)
            x[0] ^= swap | (~kept & low)
            if axis:
                x[axis] ^= swap
    for axis in range(1, axes):
        x[axis] ^= x[axis - 1]
    flip = np.zeros(x.shape[1], np.uint8)
    for level in range(bits - 1, 0, -1):
        flip ^= -((x[-1] >> np.uint8(level)) & one) & np.uint8((1 << level) - 1)
    x ^= flip
    key = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for first in range(0, axes, 8):
            some = x[first : first + 8]
            digits = np.zeros(x.shape[1], np.uint8)
            for bit in some:
                digits = (digits << one) | ((bit >> np.uint8(level)) & one)
            key = (key << np.uint64(len(some))) | digits
    return key


def _matrix(column: pa.Array, dtype: str) -> np.ndarray:
    """Rows of a column of equally long binary values."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype).reshape(len(column), -1).astype(np.float64) if len(column) else np.empty((0, 0))


def _unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest  # so that squares neither overflow nor vanish
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _entries(vectors: DataFrame, ids: str, column: str) -> tuple[DataFrame, str, int]:
    """Usable rows (vec_id, vec as bytes, key of the vector), the components' type, and the length of a vector."""
    kind = "f4" if isinstance(vectors.schema[column].dataType.elementType, T.FloatType) else "f8"
    whole = vectors.select(F.col(ids).cast("long").alias("vec_id"), F.col(column).alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    lengths = whole.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    length = lengths["size"] if lengths else 0

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(lists), length)
            good = np.isfinite(flat).all(axis=1) & (flat != 0).any(axis=1)  # a NULL component reads as NaN
            vec = pa.array([row.tobytes() for row in flat[good]], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), vec], ["vec_id", "vec"])

    fitting = whole.where((F.size("v") == length) & (F.size("v") > 0))
    return fitting.mapInArrow(rows, "vec_id long, vec binary").withColumn("key", F.md5("vec")), kind, length


def _sample(entries: DataFrame, n: int) -> pd.DataFrame:
    """(place, vec) of the ``FIT_ROWS`` entries of the smallest keys."""
    # Keys are hashes, so about twice as many lie below the bound, of all tasks together; without it each task would send that many.
    low = entries.where(F.col("key") < f"{(2 * FIT_ROWS << 64) // n:016x}") if n > 2 * FIT_ROWS else entries
    sample = low.orderBy("key").limit(FIT_ROWS).select("place", "vec").toPandas()
    return sample if len(sample) == min(n, FIT_ROWS) else entries.orderBy("key").limit(FIT_ROWS).select("place", "vec").toPandas()


def _turns(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every ordering's axes, and the lower ends and widths of its cells, for a sample of vectors of length 1."""
    random = np.random.default_rng(SEED)
    length = unit.shape[1]
    axes = min(AXES, length)
    turns, lows, widths = [], [], []
    for _ in range(ORDERINGS):
        turn = np.linalg.qr(random.standard_normal((length, axes)))[0]
        made = unit @ turn
        spread = np.maximum(6 * made.std(axis=0), 1e-9)
        # Cells cover one and a half times the spread; the shift says where within it the data lie.
        lows.append(made.mean(axis=0) - spread / 2 - random.uniform(0, 0.5, axes) * spread)
        widths.append(1.5 * spread)
        turns.append(turn)
    return np.stack(turns), np.stack(lows), np.stack(widths)


def _keys(vectors: np.ndarray, turns: np.ndarray, lows: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Hilbert keys of vectors of length 1, a row for each ordering."""
    made = (vectors @ np.concatenate(turns, axis=1)).reshape(len(vectors), *lows.shape)
    cells = np.clip(np.floor((made - lows) / widths * (1 << BITS)), 0, (1 << BITS) - 1).astype(np.uint8)
    keys = hilbert_keys(cells.reshape(-1, lows.shape[1]), BITS) ^ np.uint64(1 << 63)  # signed order as unsigned
    return keys.view(np.int64).reshape(len(vectors), -1).T


def _ranges(keys: np.ndarray, places: np.ndarray, ends: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The range of every (key, place): how many of the ends are not after it."""
    end_keys, end_places = ends
    found, last = np.searchsorted(end_keys, keys, "left"), np.searchsorted(end_keys, keys, "right")
    for end in np.unique(ragged(found[found < last], (last - found)[found < last])):  # ends of keys that are here
        found += (end_keys[end] == keys) & (end_places[end] <= places)
    return found


def _packed_keys(vectors: DataFrame, segments: int, kind: str, dtype: str, fitted: tuple, ends: list) -> DataFrame:
    """(ordering, range, keys, places): the keys of every entry in some orderings, many to a row."""
    spark, path = vectors.sparkSession, vectors.staged_at
    shared = spark.sparkContext.broadcast((fitted, ends))
    parts = len(ends[0][0]) + 1

    def packed(keys: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
        rows = []
        for ordering, (key, of) in enumerate(zip(keys, shared.value[1])):
            range_ = _ranges(key, places, of)
            order = np.argsort(range_, kind="stable")
            cuts = np.searchsorted(range_[order], np.arange(parts + 1))
            for part in np.flatnonzero(np.diff(cuts)):
                some = order[cuts[part] : cuts[part + 1]]
                rows.append((ordering, part, key[some].tobytes(), places[some].astype(dtype).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["ordering", "range", "keys", "places"])

    @tidy
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment in (of for batch in batches for of in batch.column(0).to_pylist()):
            keys, places, held = [], [], 0
            for row in _rows_of(path, segment, ["places", "vecs"]):
                places.append(np.frombuffer(row["places"], np.int64))
                keys.append(_keys(_unit(_vectors_of(row["vecs"], kind, len(places[-1]))), *shared.value[0]))
                held += len(places[-1])
                if held >= PACKED:
                    yield packed(np.concatenate(keys, axis=1), np.concatenate(places))
                    keys, places, held = [], [], 0
            if held:
                yield packed(np.concatenate(keys, axis=1), np.concatenate(places))

    return spark.range(0, segments, 1, segments).mapInArrow(rows, "ordering int, range int, keys binary, places binary")


def _sorted_range(segment: int, dtype: str):
    """The places of a range of an ordering with their ranks in the range, by segment of places."""

    def ranked(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(group["keys"]), np.int64)
        places = np.frombuffer(b"".join(group["places"]), dtype).astype(np.int64)
        order = np.argsort(keys)
        if (np.diff(keys[order]) == 0).any():
            order = np.lexsort((places, keys))
        ranks = np.empty(len(keys), np.uint32)
        ranks[order] = np.arange(len(keys), dtype=np.uint32)
        of = places // segment
        order = np.argsort((of - of.min()).astype(np.min_scalar_type(of.max() - of.min())), kind="stable")  # by radix, up to 2^16 segments
        places, ranks, of = places[order], ranks[order], of[order]
        cuts = [0, *(np.flatnonzero(np.diff(of)) + 1), len(of)]
        ordering, range_ = group["ordering"].iloc[0], group["range"].iloc[0]
        out = [(of[i], ordering, range_, j - i, (places[i:j] % segment).astype("<u2").tobytes(), ranks[i:j].tobytes()) for i, j in zip(cuts[:-1], cuts[1:])]
        return pd.DataFrame(out, columns=["segment", "ordering", "range", "n", "at", "ranks"])

    return ranked


def _by_segment(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder, the rows of each segment in a folder of their own."""
    path = fresh_path(df.sparkSession, name)
    df.repartition("segment").write.partitionBy("segment").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.staged_at = path
    return table


def _rows_of(path: str, segment: int, columns: list[str]) -> Iterator[dict]:
    """The stored rows of a segment."""
    fs, root = file_system(path)
    for file in fs.get_file_info(pafs.FileSelector(f"{root}/segment={segment}")):
        if file.base_name.endswith(".parquet") and not file.base_name.startswith(("_", ".")):
            with fs.open_input_file(file.path) as source:
                for batch in pq.ParquetFile(source).iter_batches(batch_size=4, columns=columns, use_threads=False):
                    yield from batch.to_pylist()


def _vectors_of(data: bytes, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(n, -1).astype(np.float64)


def _placed(entries: DataFrame, segment: int) -> DataFrame:
    """(segment, places, first_ids, vecs): the entries of a segment, many to a row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            places, vecs, firsts = batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(2).to_numpy()
            of = places // segment
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1), len(of)]
            out = [(of[i], places[i:j].tobytes(), firsts[i:j].tobytes(), b"".join(vecs[i:j])) for i, j in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), *3 * (pa.binary(),)))], ["segment", "places", "first_ids", "vecs"])

    return _by_segment(entries.select("place", "vec", "first_id").mapInArrow(rows, "segment long, places binary, first_ids binary, vecs binary"), "placed-vectors")


def _ranks(vectors: DataFrame, sample: pd.DataFrame, n: int, kind: str, segment: int) -> list[DataFrame]:
    """(segment, ranks): the exact ranks of a segment's entries, a row of them for each ordering; ``ROUND`` orderings in a table."""
    spark, segments, dtype = vectors.sparkSession, -(-n // segment), _dtype(n)
    unit, places = _unit(_vectors_of(b"".join(sample["vec"]), kind, len(sample))), sample["place"].to_numpy()
    parts = min(-(-n // RANGE), len(sample))
    turns = _turns(unit)
    tables = []
    for first in range(0, ORDERINGS, ROUND):
        fitted = tuple(x[first : first + ROUND] for x in turns)
        ends = []
        for keys in _keys(unit, *fitted):
            order = np.lexsort((places, keys))[np.arange(1, parts) * len(sample) // parts]
            ends.append((keys[order], places[order]))
        packed = _packed_keys(vectors, segments, kind, dtype, fitted, ends).groupBy("ordering", "range")
        within = staged(packed.applyInPandas(_sorted_range(segment, dtype), "segment long, ordering int, range int, n long, at binary, ranks binary"), "hilbert-ranges")
        sizes = np.zeros((len(ends), parts + 1), np.int64)
        for r in within.groupBy("ordering", "range").agg(F.sum("n").alias("n")).collect():  # a row for each range of keys
            sizes[r["ordering"], r["range"] + 1] = r["n"]
        before = spark.sparkContext.broadcast(sizes.cumsum(axis=1))
        ranks = within.groupBy("segment").applyInPandas(_whole_ranks(before, segment, n), "segment long, ranks binary")
        tables.append(_by_segment(ranks, "hilbert-ranks"))
        discard(within)
    return tables


def _whole_ranks(before: Broadcast, segment: int, n: int):
    """The ranks of a segment's entries, from those in ranges and the entries ``before`` each range."""

    def whole(group: pd.DataFrame) -> pd.DataFrame:
        of = group["segment"].iloc[0]
        ranks = np.empty((len(before.value), min(segment, n - of * segment)), _dtype(n))
        for ordering, range_, at, some in zip(group["ordering"], group["range"], group["at"], group["ranks"]):
            ranks[ordering, np.frombuffer(at, "<u2")] = np.frombuffer(some, np.uint32) + before.value[ordering, range_]
        return pd.DataFrame({"segment": [of], "ranks": [ranks.tobytes()]})

    return whole


def _ranks_of(paths: list[str], segment: int, dtype: str, size: int) -> np.ndarray:
    """The ranks of a segment's entries, a row for each ordering."""
    return np.concatenate([np.frombuffer(row["ranks"], dtype).reshape(-1, size) for path in paths for row in _rows_of(path, segment, ["ranks"])])


def _dtype(entries: int) -> str:
    return "<u4" if entries < 1 << 32 else "<u8"


def _half(entries: int) -> int:
    return max(LEAST_WINDOW, int(np.ceil(entries * WINDOW_SHARE))) // 2


def _met(asking: np.ndarray, query: np.ndarray, asked: np.ndarray, found: np.ndarray, half: int) -> np.ndarray:
    """Which pairs of a query and a vector are within a window of an ordering; ranks have a row for each ordering."""
    met = np.zeros(len(query), bool)
    for of_query, of_vector in zip(asking, asked):
        a, b = of_query[query], of_vector[found]
        met |= np.maximum(a, b) - np.minimum(a, b) <= half  # ranks have no sign
    return met


class _Best:
    """The best candidates met so far of the queries of a task, by score, ties by the smaller id."""

    def __init__(self, vectors: np.ndarray, ranks: np.ndarray, k: int, half: int):
        n, length = vectors.shape
        self.vectors, self.ranks, self.half = vectors, ranks, half
        self.short = vectors.astype(np.float32)
        # Twice what rounding to single precision and adding up in it can make of a cosine.
        self.error = (length + 4) * 2.0**-23
        self.least = np.full(n, -np.inf, np.float32)
        self.score, self.place, self.first = np.full((n, k + 1), -np.inf), np.full((n, k + 1), -1), np.full((n, k + 1), np.iinfo(np.int64).max)
        self.seen = 0

    def meet(self, places: np.ndarray, firsts: np.ndarray, vectors: np.ndarray, ranks: np.ndarray) -> None:
        """Score those of the vectors that are candidates of a query and could be among its best."""
        short, at = vectors.astype(np.float32), 0
        while at < len(short):
            end = at + min(BLOCK, max(16, self.seen))  # few at first, when all are among the best
            block = np.ascontiguousarray(short[at:end].T)
            pairs = []
            for low in range(0, len(self.short), QUERY_TILE):
                near, least = self.short[low : low + QUERY_TILE] @ block, self.least[low : low + QUERY_TILE]
                hot = np.flatnonzero(near.max(axis=1) >= least)
                if len(hot):
                    query, found = np.nonzero(near[hot] >= least[hot, None])
                    pairs.append((hot[query] + low, found + at))
            for i in range(0, len(pairs), 16):
                query, found = (np.concatenate(x) for x in zip(*pairs[i : i + 16]))
                met = _met(self.ranks, query, ranks, found, self.half)
                self._keep(query[met], found[met], places, firsts, vectors)
            self.seen += block.shape[1]
            at = end

    def _keep(self, query: np.ndarray, found: np.ndarray, places: np.ndarray, firsts: np.ndarray, vectors: np.ndarray) -> None:
        """Rank the candidates by exact cosine among the best so far; ``query`` ascends."""
        if not len(query):
            return
        score = np.concatenate([(vectors[found[i : i + 4096]] * self.vectors[query[i : i + 4096]]).sum(axis=1) for i in range(0, len(query), 4096)])
        changed, of = np.unique(query, return_inverse=True)
        size = self.score.shape[1]
        of = np.concatenate((np.repeat(np.arange(len(changed)), size), of))
        columns = [np.concatenate((old[changed].ravel(), new)) for old, new in ((self.score, score), (self.first, firsts[found]), (self.place, places[found]))]
        order = np.lexsort((columns[1], -columns[0], of))
        of = of[order]
        kept = order[np.arange(len(of)) - np.searchsorted(of, of) < size]
        self.score[changed], self.first[changed], self.place[changed] = (c[kept].reshape(-1, size) for c in columns)
        self.least[changed] = np.nextafter((self.score[changed, -1] - self.error).astype(np.float32), np.float32(-np.inf))


def _nearest(vectors: str, ranks: list[str], entries: int, slices: int, segment: int, kind: str, half: int, k: int):
    """A task's queries (slice, place, vec, ranks) over the segments of their slice: the k + 1 best candidates of each."""
    segments, dtype = -(-entries // segment), _dtype(entries)

    @tidy
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            for slice_ in np.unique(batch.column(0).to_numpy()):
                asked.setdefault(int(slice_), []).append(batch.filter(pa.array(batch.column(0).to_numpy() == slice_)))
        for slice_ in list(asked):
            queries = pa.Table.from_batches(asked.pop(slice_))
            own = np.frombuffer(b"".join(queries["ranks"].to_pylist()), dtype).reshape(len(queries), -1).T.copy()
            asking = queries["place"].to_numpy()
            found = _Best(_unit(_matrix(queries["vec"], kind)), own, k, half)
            del queries
            for of in range(slice_ * segments // slices, (slice_ + 1) * segments // slices):
                first = of * segment
                met = _ranks_of(ranks, of, dtype, min(segment, entries - first))
                for row in _rows_of(vectors, of, ["places", "first_ids", "vecs"]):
                    places, firsts = np.frombuffer(row["places"], np.int64), np.frombuffer(row["first_ids"], np.int64)
                    found.meet(places, firsts, _unit(_vectors_of(row["vecs"], kind, len(places))), met[:, places - first])
            query, nth = np.nonzero(found.place >= 0)
            columns = [asking[query], *(x[query, nth] for x in (found.place, found.score, found.first))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query", "place", "score", "first_id"])

    return best


def _asking(vectors: str, ranks: list[str], entries: int, segment: int):
    """The vectors and ranks of queries (place), which a task reads from their segments."""

    @tidy
    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.concatenate([np.empty(0, np.int64), *(batch.column(0).to_numpy() for batch in batches)])
        for of in np.unique(asked // segment).tolist():
            first = of * segment
            own = _ranks_of(ranks, of, _dtype(entries), min(segment, entries - first))
            for row in _rows_of(vectors, of, ["places", "vecs"]):
                places = np.frombuffer(row["places"], np.int64)
                vecs = np.frombuffer(row["vecs"], np.uint8).reshape(len(places), -1)
                some = np.flatnonzero(np.isin(places, asked))
                columns = [pa.array(places[some]), pa.array([vecs[i].tobytes() for i in some], pa.binary()), pa.array([own[:, places[i] - first].tobytes() for i in some], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["place", "vec", "ranks"])

    return taken


def candidates(ranks: DataFrame, queries: DataFrame, entries: int, asked: int) -> DataFrame:
    """(query, block, places): the distinct candidates of every query (place), by block of places, as ``search`` meets them.

    ``ranks`` has (ordering, rank, place). Their number grows with the square of the table, so ``search`` stores none.
    """
    half, block_size = _half(entries), BLOCK
    dtype = _dtype(entries)
    chunks = -(-asked // CHUNK) or 1
    of = F.floor(F.col("place") / block_size)
    every = F.sort_array(F.collect_list(F.struct("ordering", "rank")))["rank"].alias("ranks")
    placed = ranks.groupBy("place").agg(every)
    found = placed.select(of.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "place", "ranks")
    chunk = F.pmod(F.xxhash64("place"), F.lit(chunks)).cast("int")
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.lit((entries - 1) // block_size).cast("long")))
    asks = placed.join(queries, "place").select(blocks.alias("block"), chunk.alias("chunk"), "place", "ranks")

    def listed(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy(bool)
        some = group[~asks].sort_values("place")
        places, own = some["place"].to_numpy(), np.stack(some["ranks"].to_list(), axis=1)
        out = []
        for query, ranks in zip(group["place"][asks], group["ranks"][asks]):
            met = places[_met(ranks[:, None], np.zeros(len(places), int), own, np.arange(len(places)), half)]
            if len(met):
                out.append((query, met[0] // block_size, met.astype(dtype).tobytes()))
        return pd.DataFrame(out, columns=["query", "block", "places"])

    both = found.withColumn("asks", F.lit(False)).union(asks.withColumn("asks", F.lit(True)))
    return both.groupBy("block", "chunk").applyInPandas(listed, "query long, block long, places binary")


def search(vectors: DataFrame, is_query: Column, k: int = 5, ids: str = "vec_id", column: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows found for every row that ``is_query`` (a condition on ``vec_id``) selects.

    Returns query_id, rank (from 1), vec_id and score.
    """
    spark = prepare(vectors.sparkSession)
    with prompt_cleanup(spark):
        usable, kind, length = _entries(vectors, ids, column)
        known = staged(usable.select("vec_id", "key").distinct(), "vector-ids")
        smallest = Window.partitionBy("key").orderBy("vec_id")
        first = usable.withColumn("nth", F.row_number().over(smallest)).where("nth = 1").select("key", "vec", F.col("vec_id").alias("first_id"))
        groups = staged(first.withColumn("gid", F.monotonically_increasing_id()), "vector-entries")
        part = F.shiftright("gid", 33)
        sizes = groups.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()  # one row per partition
        entries = sum(r["n"] for r in sizes)
        if entries == 0:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        before = np.cumsum([0, *(r["n"] for r in sizes)])[:-1]
        bases = spark.createDataFrame([(r["part"], int(b)) for r, b in zip(sizes, before)], "part long, base long")
        place = F.col("base") + F.col("gid").bitwiseAND(F.lit((1 << 33) - 1))
        numbered = groups.withColumn("part", part).join(F.broadcast(bases), "part").select("key", "vec", "first_id", place.alias("place"))
        places = numbered.select("key", "place")
        members = known.withColumn("nth", F.row_number().over(smallest)).where(F.col("nth") <= k + 1)
        members = staged(members.select("key", "vec_id").join(places, "key").select("place", "vec_id"), "entry-members")
        asking = staged(known.where(is_query).select(F.col("vec_id").alias("query_id"), "key").join(places, "key").groupBy("query_id").agg(F.min("place").alias("place")), "queries")
        discard(known)

        tasks = 2 * spark.sparkContext.defaultParallelism
        segment = min(SEGMENT, max(BLOCK, -(-entries // tasks)))
        segments = -(-entries // segment)
        sample = _sample(numbered, entries)
        stored = _placed(numbered, segment)
        discard(groups)
        ranks = _ranks(stored, sample, entries, kind, segment)
        paths = [x.staged_at for x in ranks]
        asked = asking.select("place").distinct().repartitionById(segments, F.floor(F.col("place") / segment).cast("int"))
        asked = staged(asked.mapInArrow(_asking(stored.staged_at, paths, entries, segment), "place long, vec binary, ranks binary"), "asking-vectors")

        chunks = max(1, -(-asked.count() // max(1, min(CHUNK, QUERY_BYTES // (8 * length)))))
        slices = min(segments, -(-tasks // chunks))
        chunk = F.pmod(F.xxhash64("place"), F.lit(chunks)).cast("int")
        dealt = asked.select(F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), "place", "vec", "ranks")
        dealt = dealt.repartitionById(chunks * slices, chunk * slices + F.col("slice"))
        near = dealt.mapInArrow(_nearest(stored.staged_at, paths, entries, slices, segment, kind, _half(entries), k), "query long, place long, score double, first_id long")
        by_score = Window.partitionBy("query").orderBy(F.desc("score"), "first_id")
        near = near.withColumn("nth", F.row_number().over(by_score)).where(F.col("nth") <= k + 1)
        near = staged(near.select("query", "place", "score").join(members, "place").select(F.col("query").alias("place"), "vec_id", "score"), "near-vectors")
        discard(stored, asked, *ranks)
    best = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
    lists = near.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= 2 * k + 2).groupBy("place").agg(
        F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("near")
    )
    # A list has at most 2 k + 2 entries: a query drops its own id and takes the next k.
    others = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    taken = asking.join(lists, "place").select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "x"))
    return taken.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)
