"""A language model as a probabilistic suffix tree over word tokens.

Symbols are all words, the beginning and the end of a text. Contexts grow level by level, up to ``DEPTH`` symbols: one
that occurs at least ``LEAST_CONTEXT`` times in training may be extended to the left, and its transitions that occur
twice or more are explicit. A context is retained if its next-symbol distribution diverges from that
of its longest retained suffix by more than its parameters cost (its likelihood gain, which is its count times the
divergence, exceeds half the logarithm of its count for every explicit symbol). Distributions are
discounted and filled up from the suffix, down to the smoothed word frequencies (c + 1) / (N + V + 1). A token is scored in
the state of the longest retained suffix of what precedes it. Probabilities of all words and one unknown word sum to 1 in
every state, and the root alone gives the base score.

The limits are absolute counts, so symbols, contexts and transitions grow with the corpus. The tree is a table by the
hash of a sequence of words. A state's probability divided by its suffix's is what the state adds: the
share left to the suffix, which its context brings, and for an explicit symbol a correction, which the transition brings. A
text's score is hence the sum of the values of all its sequences of up to ``DEPTH`` + 1 words: the ``HOT_KEYS`` most
frequent ones are broadcast, all others are grouped with the tree. Bitmaps of ``BITS`` bits keep sequences that
are in no table out of the shuffles (twice as many for those joined with the texts); full ones would let more through and change no result.

Counts, tree and terms move between tasks as packed columns, a row for each task and bucket, since most sequences
occur once and a row for each would cost more than its content. Buckets are about as many as shuffle partitions. Words,
contexts and terms are dealt by their own key; a transition by its last two words, so that it meets the one from the suffix.

Rows: NULL and empty texts are an end alone; rows without doc_id are learned from; repeated rows each count and each
get a row; without training rows the score is that of an empty table of counts; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial, reduce, wraps

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import SortedHashes, buffers, discard, mix, not_blank, prepare, slices, staged, words

DEPTH = 3
LEAST_CONTEXT, LEAST_ARC = 12, 2
DISCOUNT = 0.75
HOT_KEYS = 1 << 20
TOP_COUNT = 100_000
HELD_ROWS, SLICE_BYTES = 1 << 19, 1 << 18
MESSAGE_ROWS, BATCH_BYTES = 1 << 13, 1 << 21
#: While a model is learned or used: shuffle files go when their query ends, and grouped rows reach Python in small batches.
SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}
BITS = 27

BEGIN, END = np.uint64(0x5DEECE66D1234567), np.uint64(0xB5297A4D3F84D5B5)  # symbols beside the hashes of words
STEP = np.uint64(0x9E3779B97F4A7C15)


def chain(sequence: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Key of a sequence of symbols and one more; that of one symbol is the symbol."""
    return mix(sequence * STEP + symbol)


def stream(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of a slice of texts, each with its beginning and end, and the places of the beginnings (one more than texts)."""
    rows = len(at) - 1
    begin = at + 2 * np.arange(rows + 1)
    out = np.empty(len(hashes) + 2 * rows, np.uint64)
    out[np.arange(len(hashes)) + 2 * np.repeat(np.arange(rows), np.diff(at)) + 1] = hashes
    out[begin[:-1]], out[begin[1:] - 1] = BEGIN, END
    return out, begin


def sequences(symbols: np.ndarray, begin: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For lengths 1, 2, ...: key of the symbols that end at each place, and whether they lie in one text."""
    back = np.arange(len(symbols)) - np.repeat(begin[:-1], np.diff(begin))
    keys = symbols
    for length in range(1, most + 1):
        yield keys, back >= length - 1
        keys = chain(np.append(np.uint64(0), keys[:-1]), symbols)


MESSAGE = "bucket int, kind string, source long, data binary"
MESSAGES = pa.schema([("bucket", pa.int32()), ("kind", pa.string()), ("source", pa.int64()), ("data", pa.binary())])


def pack(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit values as planes of equal bytes, which compress where values are small or sorted."""
    return np.stack([c.view(np.uint64) for c in columns]).view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1).tobytes()


def unpack(data, columns: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(columns, 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.uint64)[..., 0]


def _batches(messages: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for message in messages:
        rows.append(message)
        size += len(message[3])
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), MESSAGES)], schema=MESSAGES)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), MESSAGES)], schema=MESSAGES)


def _sent(bucket: int, kind: str, source: int, *columns: np.ndarray) -> Iterator[tuple]:
    """Messages of these columns for one bucket."""
    for first in range(0, len(columns[0]), MESSAGE_ROWS):
        yield bucket, kind, source, pack(*(c[first : first + MESSAGE_ROWS] for c in columns))


def _dealt(kind: str, source: int, bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """Messages of these columns for every bucket that gets any row, in the given order of rows."""
    bucket = bucket.astype(np.uint16 if len(bucket) == 0 or bucket.max() < 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(order) else []
    for first, last in zip(start, np.append(start[1:], len(order))):
        part = order[first:last]
        yield from _sent(int(bucket[first]), kind, source, *(c[part] for c in columns))


class _Inbox:
    """Messages of some rows by kind."""

    def __init__(self, rows: pa.Table | pa.RecordBatch):
        self.found = defaultdict(list)
        for kind, source, data in zip(rows["kind"].to_pylist(), rows["source"].to_pylist(), rows["data"]):
            self.found[kind].append((source, data.as_buffer()))

    def all(self, kind: str, columns: int) -> list[np.ndarray]:
        parts = [unpack(data, columns) for _, data in self.found[kind]]
        return list(np.concatenate(parts, axis=1)) if parts else [np.empty(0, np.uint64)] * columns

    def each(self, kind: str, columns: int) -> Iterator[tuple[int, np.ndarray]]:
        return ((source, unpack(data, columns)) for source, data in self.found[kind])


def _grouped(work: Callable, *frames: DataFrame) -> DataFrame:
    """The messages that ``work`` makes from each bucket's messages."""

    def run(table: pa.Table) -> pa.Table:
        out = pa.Table.from_batches(_batches(work(table["bucket"][0].as_py(), _Inbox(table))), MESSAGES)
        pa.default_memory_pool().release_unused()
        return out

    return reduce(DataFrame.unionByName, frames).groupBy("bucket").applyInArrow(run, MESSAGE)


def _only(table: DataFrame, *kinds: str) -> DataFrame:
    return table.where(F.col("kind").isin(*kinds))


def _starts(keys: np.ndarray) -> np.ndarray:
    """First places of the runs of equal keys."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)


def _folded(keys: np.ndarray, sums: list[np.ndarray], *firsts: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct keys, the sums of some columns for each, and others' values at one of its rows."""
    order = np.argsort(keys)
    keys = keys[order]
    start = _starts(keys)
    added = [np.add.reduceat(c[order], start) if len(start) else c[:0] for c in sums]
    return [keys[start], *added, *(c[order[start]] for c in firsts)]


def _places(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted key is among sorted keys, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass(frozen=True)
class Buckets:
    """Buckets by the leading bits of a key."""

    bits: int

    @staticmethod
    def of(texts: DataFrame) -> Buckets:
        """At least twice as many as shuffle partitions, but not many more than there are megabytes of text."""
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        wanted = 2 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return Buckets(max(1, min((wanted - 1).bit_length(), (size >> 20).bit_length())))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray]]:
    """Word hashes of the texts of each batch, slice by slice."""
    values = not_blank()
    for batch in batches:
        data, offsets = buffers(batch.column(column))
        for first, last in slices(offsets, SLICE_BYTES):
            yield batch, first, last, *words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], values)


def _count_words(batches: Iterator[pa.RecordBatch], buckets: Buckets) -> Iterator[pa.RecordBatch]:
    def folded(parts):
        keys, counts = (np.concatenate(c) for c in zip(*parts))
        return _folded(keys, [counts])

    def messages():
        parts, held = [], 0
        for _, first, last, hashes, _ in _texts(batches, 0):
            parts.append(np.unique(np.append(hashes, np.full(last - first, END)), return_counts=True))
            held += len(parts[-1][0])
            if held > HELD_ROWS:
                parts = [folded(parts)]
                held = len(parts[0][0])
                if held > HELD_ROWS // 2:
                    yield from _dealt("token", 0, buckets(parts[0][0]), *parts[0])
                    parts, held = [], 0
        if parts:
            key, n = folded(parts)
            yield from _dealt("token", 0, buckets(key), key, n)

    yield from _batches(messages())


def _words(bucket: int, inbox: _Inbox) -> Iterator[tuple]:
    key, n = inbox.all("token", 2)
    key, n = _folded(key, [n.view(np.int64)])
    grown = (n >= LEAST_CONTEXT) & (key != END)
    yield from _sent(bucket, "word", bucket, key, n)
    yield from _sent(bucket, "context", bucket, key[grown], n[grown], key[grown])
    yield from _sent(bucket, "key", bucket, key[n >= LEAST_ARC])
    yield bucket, "size", bucket, pack(np.array([n.sum(), len(n), n[key == END].sum()]))


class Bits:
    """Which of some keys are there, by three bits each in the part of the bitmap that their bucket has."""

    KEPT = {"key": (1, None), "context": (3, None), "word": (2, 1), "value": (3, 2)}  # columns, and the place of the uses

    def __init__(self, messages: DataFrame, buckets: Buckets, below: int | None = None, bits: int | None = None):
        """The keys of these messages, or of those among them used less than ``below`` times, in 2^BITS or 2^bits bits."""
        self.buckets, self.part = buckets, max(3, (bits or BITS) - buckets.bits)
        mark = partial(self._mark, below=below)
        found = messages.groupBy("bucket").applyInArrow(lambda t: mark(t), "bucket int, data binary").toArrow()
        self.bits = np.zeros((1 << buckets.bits, 1 << (self.part - 3)), np.uint8)
        for bucket, data in zip(found["bucket"].to_pylist(), found["data"]):
            self.bits[bucket] = np.frombuffer(data.as_buffer(), np.uint8)
        self.bits = self.bits.reshape(-1)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, ...]:
        """Places in the part of each key."""
        mask = np.uint64((1 << self.part) - 1)
        return tuple((keys >> np.uint64(shift)) & mask for shift in (64 - self.buckets.bits - self.part, 18, 0))

    def _mark(self, table: pa.Table, below: int | None) -> pa.Table:
        inbox, marks = _Inbox(table), np.zeros(1 << self.part, bool)
        for kind, (columns, uses) in self.KEPT.items():
            for _, found in inbox.each(kind, columns):
                keys = found[0] if below is None else found[0][found[uses].view(np.int64) < below]
                for place in self._places(keys):
                    marks[place] = True
        return pa.table({"bucket": pa.array([table["bucket"][0].as_py()], pa.int32()), "data": pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())})

    def have(self, keys: np.ndarray) -> np.ndarray:
        part = self.buckets(keys).view(np.uint64) << np.uint64(self.part)
        found = ((self.bits[((part | p) >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 for p in self._places(keys))
        return reduce(np.bitwise_and, found).astype(bool)


def _count_arcs(batches: Iterator[pa.RecordBatch], shared, depth: int, buckets: Buckets) -> Iterator[pa.RecordBatch]:
    contexts, explicit = shared.value

    def folded(parts):
        context, symbol, pair = (np.concatenate(c) for c in zip(*parts))
        parts.clear()
        key = chain(context, symbol)
        _, n, context, symbol, pair = _folded(key, [np.ones(len(key), np.int64)], context, symbol, pair)
        order = np.argsort(context)  # equal contexts side by side
        return _dealt("pair", 0, pair[order], context[order], symbol[order], n[order])

    def messages():
        parts, held = [], 0
        for _, _, _, hashes, at in _texts(batches, 0):
            symbols, begin = stream(hashes, at)
            *_, (keys, inside) = sequences(symbols, begin, depth)
            before = np.flatnonzero(inside[:-1] & (symbols[:-1] != END))
            before = before[contexts.have(keys[before])]
            before = before[explicit.have(keys[before + 1])]  # the same symbol after the suffix is as frequent
            if len(before):
                symbol = symbols[before + 1]
                parts.append((keys[before], symbol, buckets(chain(symbols[before], symbol)).astype(np.int32)))
                held += len(before)
            if held > HELD_ROWS:
                yield from folded(parts)
                parts, held = [], 0
        if parts:
            yield from folded(parts)

    yield from _batches(messages())


def _arcs(bucket: int, inbox: _Inbox, depth: int, buckets: Buckets) -> Iterator[tuple]:
    """Explicit transitions, and what they sum up to in their contexts."""
    context, symbol, n = inbox.all("pair", 3)
    _, n, context, symbol = _folded(chain(context, symbol), [n.view(np.int64)], context, symbol)
    kept = n >= LEAST_ARC
    context, symbol, n = context[kept], symbol[kept], n[kept]
    order = np.argsort(context)
    context, symbol, n = context[order], symbol[order], n[order]
    yield from _sent(bucket, "arc", bucket, context, symbol, n)
    key, explicit, kinds = _folded(context, [n, np.ones(len(n), np.int64)])
    yield from _dealt("sum", bucket, buckets(key), key, explicit, kinds)
    if depth == 1:  # asks for the counts of the words
        symbols = np.unique(symbol)
        yield from _dealt("ask", bucket, buckets(symbols), symbols)


def _contexts(bucket: int, inbox: _Inbox, norm: int) -> Iterator[tuple]:
    """What contexts leave to their suffixes, for themselves and for each bucket of their transitions."""
    key, seen, suffix = inbox.all("context", 3)
    order = np.argsort(key)
    key, seen, suffix = key[order], seen[order].view(np.int64), suffix[order]
    explicit, kinds = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
    asked = [(source, found, *_places(key, found[0])) for source, found in inbox.each("sum", 3)]
    for _, found, at, there in asked:
        explicit[at[there]] += found[1][there].view(np.int64)
        kinds[at[there]] += found[2][there].view(np.int64)
    rest = seen - explicit
    backoff = (rest + DISCOUNT * kinds) / seen
    used = kinds > 0
    yield from _sent(bucket, "state", bucket, key[used], seen[used], kinds[used], rest[used], backoff[used])
    for source, _, at, there in asked:
        at = at[there]
        yield from _sent(source, "reply", bucket, key[at], seen[at], backoff[at], suffix[at])
    if inbox.found["ask"]:
        word, n = inbox.all("word", 2)
        order = np.argsort(word)
        word, log_p = word[order], np.log10((n[order].view(np.int64) + 1) / norm)
        for source, found in inbox.each("ask", 1):
            at, there = _places(word, found[0])
            yield from _sent(source, "below", bucket, word[at[there]], log_p[at[there]])


def _weigh(bucket: int, inbox: _Inbox, depth: int, buckets: Buckets) -> Iterator[tuple]:
    """Transitions with their probabilities in their context and in its suffix, and the gain of each context."""
    context, symbol, n = inbox.all("arc", 3)
    key, seen, backoff, suffix = inbox.all("reply", 4)
    order = np.argsort(key)
    at, there = _places(key[order], context)
    at, context, symbol, n = order[at[there]] if len(order) else at[:0], context[there], symbol[there], n[there].view(np.int64)
    if depth == 1:
        lower, log_lower = inbox.all("below", 2)
        below = symbol
    else:
        within, lower, _, log_below, log_p = inbox.all("weighed", 5)
        log_lower = np.where(_places(np.sort(inbox.all("left", 2)[0]), within)[1], log_p, log_below)
        below = chain(suffix[at], symbol)
    order = np.argsort(lower)
    place, there = _places(lower[order], below)
    place, at, context, symbol, n, below = order[place[there]] if len(order) else place[:0], at[there], context[there], symbol[there], n[there], below[there]
    if not len(n):
        return
    log_below = log_lower[place].view(np.float64)
    log_p = np.log10((n - DISCOUNT) / seen[at].view(np.int64) + backoff[at].view(np.float64) * np.power(10.0, log_below))
    key = chain(context, symbol)
    yield from _sent(bucket, "weighed", bucket, context, key, n, log_below, log_p)
    own, gain = _folded(context, [n * (log_p - log_below)])
    yield from _dealt("gain", bucket, buckets(own), own, gain)
    if depth < DEPTH:
        grown = (n >= LEAST_CONTEXT) & (symbol != END)
        yield from _dealt("context", bucket, buckets(key[grown]), key[grown], n[grown], below[grown])
        yield from _dealt("key", bucket, buckets(key), key)


def _judge(bucket: int, inbox: _Inbox) -> Iterator[tuple]:
    """The contexts that diverge enough from their suffixes, as values and for each bucket of their transitions."""
    states = np.stack(inbox.all("state", 5))
    key, seen, kinds, rest, backoff = states[:, np.argsort(states[0])]
    seen, kinds, rest, left = seen.view(np.int64), kinds.view(np.int64), rest.view(np.int64), np.log10(backoff.view(np.float64))
    gain, weighed = np.zeros(len(key)), np.zeros(len(key), bool)
    asked = [(source, found, *_places(key, found[0])) for source, found in inbox.each("gain", 2)]
    for _, found, at, there in asked:
        gain[at[there]] += found[1][there].view(np.float64)
        weighed[at[there]] = True
    kept = weighed & (gain + rest * left > 0.5 * kinds * np.log10(seen))
    yield from _sent(bucket, "value", bucket, key[kept], left[kept], seen[kept])
    for source, _, at, there in asked:
        at = at[there & kept[at]] if len(key) else at[:0]
        yield from _sent(source, "left", bucket, key[at], left[at])


def _values(bucket: int, inbox: _Inbox, buckets: Buckets) -> Iterator[tuple]:
    """What transitions from kept contexts add."""
    context, key, n, log_below, log_p = inbox.all("weighed", 5)
    kept, left = inbox.all("left", 2)
    order = np.argsort(kept)
    at, there = _places(kept[order], context)
    if there.any():
        left = left[order][at[there]].view(np.float64)
        value = log_p[there].view(np.float64) - log_below[there].view(np.float64) - left
        key, n = key[there], n[there]
        yield from _dealt("value", bucket, buckets(key), key, value, n)


def _rows(batches: Iterator[pa.RecordBatch], least: int = 0) -> Iterator[pa.RecordBatch]:
    """Keys, counts, values and uses of words and sequences that are used so often."""
    for batch in batches:
        for kind, data in zip(batch["kind"].to_pylist(), batch["data"]):
            found = unpack(data.as_buffer(), Bits.KEPT[kind][0])
            found = found[:, found[-1].view(np.int64) >= least]
            n, value = (found[1], np.zeros(found.shape[1])) if kind == "word" else (np.zeros(found.shape[1], np.int64), found[1].view(np.float64))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (found[0].view(np.int64), n.view(np.int64), value, found[-1].view(np.int64))], ["key", "n", "value", "uses"])


ROWS = "key long, n long, value double, uses long"


@dataclass
class Model:
    """The stored tree: messages of words (key, n), and of sequences as context and as transition (key, value, uses)."""

    words: DataFrame
    tree: DataFrame
    tokens: int  # N
    types: int  # V
    buckets: Buckets

    @property
    def norm(self) -> int:
        return self.tokens + self.types + 1

    @property
    def values(self) -> DataFrame:
        return self.tree.mapInArrow(lambda b: _rows(b), ROWS).select("key", "value", "uses")


def _frugal(work: Callable) -> Callable:
    """The same work under ``SETTINGS``."""

    @wraps(work)
    def run(table: DataFrame, *rest):
        conf = prepare(table.sparkSession).conf
        before = {name: conf.get(name) for name in SETTINGS}
        try:
            for name, value in SETTINGS.items():
                conf.set(name, value)
            return work(table, *rest)
        finally:
            for name, value in before.items():
                conf.set(name, value)

    return run


@_frugal
def fit(training: DataFrame) -> Model:
    """The tree learned from the texts of ``training``."""
    spark = training.sparkSession
    buckets = Buckets.of(training)
    words = staged(_grouped(_words, training.select("text").mapInArrow(lambda b: _count_words(b, buckets), MESSAGE)), "words")
    sizes = [unpack(r["data"], 1)[0].view(np.int64) for r in _only(words, "size").select("data").collect()]
    tokens, types, texts = (int(x) for x in np.sum([np.zeros(3, np.int64), *sizes], axis=0))
    contexts, explicit = _only(words, "context"), _only(words, "key")
    if texts >= LEAST_CONTEXT:
        begin = np.array([BEGIN])
        row = (int(buckets(begin)[0]), "context", 0, pack(begin, np.array([texts]), begin))
        contexts = contexts.unionByName(spark.createDataFrame([row], MESSAGE))
    lower, spent, values = [], [], []
    for depth in range(1, DEPTH + 1):
        counted = _count(training, contexts, explicit, depth, buckets)
        given = [contexts, _only(counted, "sum")] + ([_only(counted, "ask"), _only(words, "word")] if depth == 1 else [])
        states = staged(_grouped(partial(_contexts, norm=tokens + types + 1), *given), f"contexts-{depth}")
        parts = [_only(counted, "arc"), _only(states, "reply", "below"), *lower]
        weighed = staged(_grouped(partial(_weigh, depth=depth, buckets=buckets), *parts), f"arcs-{depth}")
        discard(counted, *spent)
        judged = staged(_grouped(_judge, _only(states, "state"), _only(weighed, "gain")), f"judged-{depth}")
        discard(states)
        lower, spent = [_only(weighed, "weighed"), _only(judged, "left")], [weighed]
        values += [_only(judged, "value"), staged(_grouped(partial(_values, buckets=buckets), *lower), f"values-{depth}")]
        contexts, explicit = _only(weighed, "context"), _only(weighed, "key")
    discard(*spent)
    return Model(_only(words, "word"), reduce(DataFrame.unionByName, values), tokens, types, buckets)


def _count(training: DataFrame, contexts: DataFrame, explicit: DataFrame, depth: int, buckets: Buckets) -> DataFrame:
    """Stored explicit transitions after the contexts of one depth, and their sums by context.

    ``explicit`` holds the transitions one level below (words at the root); only their longer forms can be explicit.
    """
    shared = training.sparkSession.sparkContext.broadcast((Bits(contexts, buckets), Bits(explicit, buckets)))
    pairs = training.select("text").mapInArrow(lambda b: _count_arcs(b, shared, depth, buckets), MESSAGE)
    counted = staged(_grouped(partial(_arcs, depth=depth, buckets=buckets), pairs), f"counted-{depth}")
    shared.destroy()
    return counted


@dataclass
class Hot:
    """The most frequent keys, and the bits of all others."""

    index: SortedHashes
    counts: np.ndarray  # of words; 0 for longer sequences
    values: np.ndarray
    others: Bits
    log_norm: float
    cut: int  # others are used less often


def hot(model: Model) -> Hot:
    """The keys to broadcast."""
    whole = model.words.unionByName(model.tree)

    def sizes(batches):
        for batch in _rows(batches):
            uses, kinds = np.unique(np.minimum(batch["uses"].to_numpy(), TOP_COUNT), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(uses), pa.array(kinds)], ["uses", "kinds"])

    counted = whole.mapInArrow(sizes, "uses long, kinds long").groupBy("uses").agg(F.sum("kinds").alias("kinds")).orderBy(F.desc("uses")).collect()
    cut, held = TOP_COUNT + 1, 0
    for row in counted:  # at most TOP_COUNT rows
        if held + row["kinds"] > HOT_KEYS:
            break
        cut, held = row["uses"], held + row["kinds"]
    found = whole.mapInArrow(lambda b: _rows(b, cut), ROWS).select("key", "n", "value").toArrow()
    keys, place = np.unique(found["key"].to_numpy().view(np.uint64), return_inverse=True)
    counts, values = np.zeros(len(keys), np.int64), np.zeros(len(keys))
    np.add.at(counts, place, found["n"].to_numpy())
    np.add.at(values, place, found["value"].to_numpy())
    return Hot(SortedHashes(keys), counts, values, Bits(whole, model.buckets, cut, BITS + 1), float(np.log10(model.norm)), cut)


HEAD = "doc_id long, n_tokens long, n_known long, logs double, gain double"


def _score(batches: Iterator[pa.RecordBatch], shared, buckets: Buckets) -> Iterator[pa.RecordBatch]:
    """Heads of texts, as far as the broadcast keys tell, and the places of their other keys, chunk by chunk."""
    known = shared.value
    log_hot = np.log10(known.counts + 1.0)

    def messages():
        chunk, heads, terms, rows, held = TaskContext.get().partitionId() << 30, [], [], 0, 0
        for batch, first, last, hashes, at in _texts(batches, 1):
            count = last - first
            symbols, begin = stream(hashes, at)
            owner = np.repeat(np.arange(count), np.diff(begin))
            logs, gains, n_known = np.where(symbols == BEGIN, 0.0, -known.log_norm), np.zeros(len(symbols)), np.zeros(len(symbols), bool)
            cold_keys, cold_rows = [], []
            for keys, inside in sequences(symbols, begin, DEPTH + 1):
                place = np.flatnonzero(inside)
                found = known.index.find(keys[place])
                some, hit = place[found >= 0], found[found >= 0]
                if len(hit):  # by place first, since terms of one place nearly cancel
                    logs[some] += log_hot[hit]
                    gains[some] += known.values[hit]
                    n_known[some] |= known.counts[hit] > 0
                rest = place[found < 0]
                rest = rest[known.others.have(keys[rest])]
                cold_keys.append(keys[rest])
                cold_rows.append(owner[rest])
            key, of = np.concatenate(cold_keys), np.concatenate(cold_rows)
            order = np.argsort(of, kind="stable")
            terms.append((key[order], of[order] + rows))
            ids = batch.column(0).slice(first, count).cast(pa.int64())
            sums = [np.bincount(owner, c, count) for c in (n_known, logs, gains)]
            heads.append((ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(at) + 1, sums[0].astype(np.int64), *sums[1:]))
            rows, held = rows + count, held + len(key)
            if held > HELD_ROWS or rows > HELD_ROWS // 8:
                yield from flushed(chunk, heads, terms)
                chunk, heads, terms, rows, held = chunk + 1, [], [], 0, 0
        if heads:
            yield from flushed(chunk, heads, terms)

    def flushed(chunk, heads, terms):
        yield chunk % (1 << buckets.bits), "head", chunk, pack(*(np.concatenate(c) for c in zip(*heads)))
        key, of = (np.concatenate(c) for c in zip(*terms))
        yield from _dealt("term", chunk, buckets(key), key, of)

    yield from _batches(messages())


def _find(bucket: int, inbox: _Inbox, buckets: Buckets, cut: int) -> Iterator[tuple]:
    """Sums for the texts of each chunk over the keys that are in the table of this bucket."""
    word, n = inbox.all("word", 2)
    other, value, uses = inbox.all("value", 3)
    cold, some = n.view(np.int64) < cut, uses.view(np.int64) < cut
    key = np.concatenate([word[cold], other[some]])
    n = np.concatenate([n[cold].view(np.int64), np.zeros(some.sum(), np.int64)])
    key, n, value = _folded(key, [n, np.concatenate([np.zeros(cold.sum()), value[some].view(np.float64)])])
    shift = np.uint64(buckets.bits)  # bits that all keys of a bucket share
    index, logs = SortedHashes(key << shift), np.log10(n + 1)
    for chunk, (wanted, of) in inbox.each("term", 2):
        at = index.find(wanted << shift)
        of, at = of[at >= 0], at[at >= 0]
        start = _starts(of)
        if len(start):
            sums = [np.add.reduceat(c, start) for c in ((n[at] > 0).astype(np.int64), logs[at], value[at])]
            yield from _sent(bucket, "found", chunk, of[start], *sums)
    for chunk, data in inbox.found["head"]:
        yield bucket, "head", chunk, data.to_pybytes()


def _sum(table: pa.Table) -> pa.Table:
    """Rows of one chunk of texts."""
    inbox = _Inbox(table)
    ids, valid, n_tokens, n_known, logs, gain = inbox.all("head", 6)
    n_known, logs, gain = n_known.view(np.int64), logs.view(np.float64), gain.view(np.float64)
    of, *cold = inbox.all("found", 4)
    of = of.view(np.int64)
    np.add.at(n_known, of, cold[0].view(np.int64))
    np.add.at(logs, of, cold[1].view(np.float64))
    np.add.at(gain, of, cold[2].view(np.float64))
    columns = [pa.array(ids.view(np.int64), mask=valid == 0), pa.array(n_tokens.view(np.int64)), pa.array(n_known), pa.array(logs), pa.array(gain)]
    return pa.Table.from_arrays(columns, [c.split()[0] for c in HEAD.split(", ")])


@_frugal
def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: token counts, the score of word frequencies alone, and the model's score (both base 10)."""
    spark = docs.sparkSession
    buckets = model.buckets
    known = hot(model)
    shared, cut = spark.sparkContext.broadcast(known), known.cut
    terms = docs.select("doc_id", "text").mapInArrow(lambda b: _score(b, shared, buckets), MESSAGE)
    found = _grouped(partial(_find, buckets=buckets, cut=cut), terms, model.words, model.tree)
    sums = found.groupBy("source").applyInArrow(lambda t: _sum(t), HEAD)
    scores = staged(sums.select(
        "doc_id", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        F.col("logs").alias("base_score"), (F.col("logs") + F.col("gain")).alias("score"),
    ), "scored")
    shared.destroy()
    return scores


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, fit(docs.where(~held_out()))).withColumn("held_out", held_out())
