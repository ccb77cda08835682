"""Language identification with interpolated Kneser-Ney models of characters, one per language.

A text is read as lower-case letters with one boundary symbol for every run of other characters. Each language
has a model of order ``ORDER``: the counts of the longest runs are discounted, shorter runs use the number of
different symbols that precede them, and every order is interpolated with the next lower one down to a uniform
distribution. All languages share sorted arrays of 64-bit run hashes with one column of log probabilities (or
log back-off weights) each; a lookup starts at the slot that the leading bits of the hash point to.

The language with the lowest cross-entropy per symbol wins (ties: the smaller name). For the rejection a text is read in
parts of ``PART`` to twice as many symbols, each in the language that is best for it, so that passages in a second known
language cost nothing. A text is ``rejected`` if its parts are on the whole above what held-back training texts of these
languages show: above their mean by six deviations of a symbol over the square root of the length, plus a slack. The
slack follows from the held-back texts alone: the median of what they have above that, plus ``SPREADS`` times the distance
from there to their ``UPPER`` quantile, so single odd or mislabelled texts do not move it. Texts without letters are
``und`` and rejected.

The models are fitted on at most ``train_rows`` labelled documents per language, those with the smallest hash of
their id; a quarter of these calibrates the rejection. Prediction reads whole texts.

Rows: a NULL text or one without a letter gives ``und`` with score 0; rows without doc_id are never learned
from; rows with an empty or NULL lang teach nothing; without any labelled row every text is ``und``; repeated
rows get the same answer; further columns are ignored or, in ``keep_identified``, kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from rosterline.llm.common import SortedHashes, buffers, mix, prepare, staged, tidy

ORDER = 4
TRAIN_ROWS = 600
PIECE = 1 << 20
BOUNDARY = 32
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SCORE_SYMBOLS = 20
DEVIATIONS = 6.0
PART = 120
UPPER, SPREADS = 0.9, 5.0

GRAMS = "lang string, gram string, count long"
PREDICTED = "doc_id long, lang_pred string, score double, symbols long, cross_entropy double, squares double, rejected boolean, excess double"

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts in a row, and where each text begins and the last one ends.

    A text with letters has ``ORDER - 1`` boundaries, then its words with one boundary after each; a text without
    has nothing.
    """
    raw = "\n".join(t.replace("\n", " ") if t else "" for t in texts).lower()
    codes = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
    breaks = np.append(np.flatnonzero(codes == 10), len(codes))
    letter = _letters()[codes]
    before = np.append(False, letter[:-1])
    keep = letter | before  # a letter, or the first other character after one
    if len(keep) and letter[-1]:
        codes, letter, keep = np.append(codes, 32), np.append(letter, False), np.append(keep, True)
    out = np.where(letter, codes, BOUNDARY)[keep].astype(np.uint32)
    place = np.append(0, np.cumsum(keep))
    # A break directly after a letter is that word's boundary, so it belongs to the text on its left.
    ends = place[np.minimum(breaks + 1, len(keep))]
    starts = np.append(0, ends[:-1])
    pad = np.where(ends > starts, ORDER - 1, 0)
    padded = np.insert(out, np.repeat(starts, pad), np.uint32(BOUNDARY))
    shift = np.cumsum(pad)
    return padded, np.append(0, ends + shift)


def run_hashes(columns: list[np.ndarray]) -> np.ndarray:
    """Hash of runs of symbols given position by position; runs of different length differ as well."""
    total = np.full(len(columns[0]), len(columns), np.uint64)
    for column in columns:
        total = total * MULTIPLIER + column.astype(np.uint64)
    return mix(total)


@dataclass
class Model:
    languages: list[str]
    runs: list[SortedHashes]  # by order, 1 first
    log_p: list[np.ndarray]  # one row per run, one column per language
    contexts: list[SortedHashes]  # of the runs one longer; none for order 1
    log_backoff: list[np.ndarray]
    floor: float
    limits: dict[str, tuple[float, float, float]]  # language: mean, deviation of a symbol, slack

    def log_probabilities(self, stream: np.ndarray) -> np.ndarray:
        """Log probability, by language, of every symbol from the ORDER-th on, each given those before it."""
        n = len(stream) - ORDER + 1
        columns = [stream[k : k + n] for k in range(ORDER)]
        place = self.runs[-1].find(run_hashes(columns))
        out = self.log_p[-1][np.maximum(place, 0)]
        missing = np.flatnonzero(place < 0)
        if len(missing) == 0:
            return out
        total = np.zeros((len(missing), len(self.languages)), np.float32)
        open_ = np.arange(len(missing))
        for order in range(ORDER - 1, -1, -1):
            part = [c[missing[open_]] for c in columns[ORDER - 1 - order :]]
            context = self.contexts[order].find(run_hashes(part[:-1])) if order else np.zeros(len(open_), np.int32)
            known = context >= 0
            total[open_[known]] += self.log_backoff[order][context[known]]
            if order == 0:
                total[open_] += self.floor
                break
            place = self.runs[order - 1].find(run_hashes(part[1:]))
            known = place >= 0
            total[open_[known]] += self.log_p[order - 1][place[known]]
            open_ = open_[~known]
            if len(open_) == 0:
                break
        out[missing] = total
        return out


@tidy
def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            stream, _ = symbols([t for t, g in zip(texts, langs) if g == lang])
            n = len(stream) - ORDER + 1
            if n <= 0:
                continue
            alphabet, dense = np.unique(stream, return_inverse=True)
            pairs, pair = np.unique(dense[:-1] * len(alphabet) + dense[1:], return_inverse=True)
            runs, counts = np.unique(pair[: n] * len(pairs) + pair[2 : n + 2], return_counts=True)
            left, right = pairs[runs // len(pairs)], pairs[runs % len(pairs)]
            grams = np.stack([alphabet[x] for part in (left, right) for x in (part // len(alphabet), part % len(alphabet))], axis=1)
            # A boundary after a boundary only occurs in padding, as do runs into the next text; those are not text.
            text = ~((grams[:, -1] == BOUNDARY) & (grams[:, -2] == BOUNDARY))
            grams, counts = grams[text], counts[text]
            raw = grams.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            names = [raw[k : k + ORDER] for k in range(0, len(raw), ORDER)]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names)), pa.array(names), pa.array(counts, pa.int64())], ["lang", "gram", "count"])


def _discount(counts: np.ndarray) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5


def _lower(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs without their first symbol, and how many different runs end in each."""
    return np.unique(grams[:, 1:], axis=0, return_counts=True)


def build(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """``counts``: by language, runs of ORDER symbols (rows of code points) and how often each was seen."""
    languages = sorted(counts)
    levels = {}
    for lang in languages:
        level, grams, n = [], *counts[lang]
        for _ in range(ORDER):
            level.append((grams, n))
            if grams.shape[1] > 1:
                grams, n = _lower(grams)
        levels[lang] = level[::-1]
    width = len(languages)
    symbols_known = len(np.unique(np.concatenate([levels[g][0][0] for g in languages]))) + 1
    floor = -float(np.log(symbols_known))
    model = Model(languages, [], [], [], [], floor, {})
    for order in range(1, ORDER + 1):
        every = np.unique(np.concatenate([levels[g][order - 1][0] for g in languages]), axis=0)
        every_hash = run_hashes(list(every.T))
        heads = np.unique(every[:, :-1], axis=0) if order > 1 else np.zeros((1, 0), every.dtype)
        head_hash = run_hashes(list(heads.T)) if order > 1 else np.zeros(1, np.uint64)
        by_run, by_head = np.argsort(every_hash), np.argsort(head_hash)
        every, every_hash, heads, head_hash = every[by_run], every_hash[by_run], heads[by_head], head_hash[by_head]
        run_index, head_index = SortedHashes(every_hash), SortedHashes(head_hash)
        head_of = head_index.find(run_hashes(list(every[:, :-1].T))) if order > 1 else np.zeros(len(every), np.int32)
        p = np.empty((len(every), width))
        log_backoff = np.zeros((len(heads), width), np.float32)
        if order > 1:
            below = model.runs[-1].find(run_hashes(list(every[:, 1:].T)))
        for column, lang in enumerate(languages):
            grams, n = levels[lang][order - 1]
            cut = _discount(n)
            seen = run_index.find(run_hashes(list(grams.T)))
            head = head_of[seen]
            total = np.bincount(head, n, len(heads))
            kinds = np.bincount(head, minlength=len(heads))
            backoff = np.where(total > 0, cut * kinds / np.maximum(total, 1), 1.0)
            log_backoff[:, column] = np.log(backoff)
            lower = np.exp(model.log_p[-1][below, column].astype(np.float64)) if order > 1 else np.full(len(every), np.exp(floor))
            p[:, column] = backoff[head_of] * lower
            p[seen, column] += (n - cut) / total[head]
        model.runs.append(run_index)
        model.log_p.append(np.log(p).astype(np.float32))
        model.contexts.append(head_index)
        model.log_backoff.append(log_backoff)
    return model


def predict(model: Model | None, texts: list[str]) -> list[tuple]:
    """Language, score, symbols, cross-entropy, mean squared surprise, rejection and excess of every text."""
    und = ("und", 0.0, 0, None, None, True, None)
    if model is None:
        return [und] * len(texts)
    width = len(model.languages)
    limits = np.array([model.limits.get(g, (0.0, 0.0, np.inf)) for g in model.languages])
    out: list[tuple] = []
    group, held = [], 0

    def flush() -> None:
        nonlocal group, held
        if not group:
            return
        stream, at = symbols(group)
        sizes = at[1:] - at[:-1] - ORDER + 1
        full = np.flatnonzero(sizes > 0)
        parts = np.maximum(sizes[full] // PART, 1)
        head = np.cumsum(parts) - parts  # the first part of each text
        start = at[full].repeat(parts) + PART * (np.arange(int(parts.sum())) - head.repeat(parts))
        stop = np.append(start[1:], 0)
        stop[head + parts - 1] = at[full] + sizes[full]
        sums, squares = np.zeros((len(start), width)), np.zeros((len(start), width))
        for first in range(0, max(len(stream) - ORDER + 1, 0), PIECE):
            last = min(first + PIECE, len(stream) - ORDER + 1)
            log_p = model.log_probabilities(stream[first : last + ORDER - 1])
            # The symbol that a run predicts is its last; those of padding belong to no text.
            begin = np.clip(start, first, last) - first
            end = np.clip(stop, first, last) - first
            some = np.flatnonzero(end > begin)
            if len(some):
                edges = np.stack([begin[some], end[some]], axis=1).ravel()
                tail = np.zeros((1, width), np.float32)
                sums[some] += np.add.reduceat(np.concatenate([log_p, tail]), edges, axis=0, dtype=np.float64)[::2]
                squares[some] += np.add.reduceat(np.concatenate([log_p * log_p, tail]), edges, axis=0, dtype=np.float64)[::2]
        found = iter(_judged(sums, squares, stop - start, head, limits) if len(full) else ())
        for size in sizes.tolist():
            if size <= 0:
                out.append(und)
                continue
            entropy, square, excess, slack = next(found)
            best = int(entropy.argmin())
            weight = np.exp(-(entropy - entropy[best]) * min(size, SCORE_SYMBOLS))
            out.append((model.languages[best], float(1 / weight.sum()), size, float(entropy[best]), float(square[best]), bool(excess > slack), float(excess)))
        group, held = [], 0

    for text in texts:
        group.append(text)
        held += len(text or "")
        if held >= PIECE:
            flush()
    flush()
    return out


def _judged(sums: np.ndarray, squares: np.ndarray, sizes: np.ndarray, head: np.ndarray, limits: np.ndarray) -> Iterator[tuple]:
    """By text: cross-entropy and mean squared surprise by language, and the excess of its parts with their slack."""
    best = sums.argmax(axis=1)
    mean, deviation, slack = limits[best].T
    size = np.add.reduceat(sizes, head)
    usual = np.add.reduceat(sizes * mean, head) + DEVIATIONS * np.sqrt(np.add.reduceat(sizes * deviation**2, head))
    excess = (-np.add.reduceat(sums.max(axis=1), head) - usual) / size
    return zip(-np.add.reduceat(sums, head) / size[:, None], np.add.reduceat(squares, head) / size[:, None], excess, np.add.reduceat(sizes * slack, head) / size)


PREDICTED_ARROW = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("symbols", pa.int64()), ("cross_entropy", pa.float64()), ("squares", pa.float64()), ("rejected", pa.bool_()), ("excess", pa.float64())])


def _predict_rows(docs: DataFrame, model) -> DataFrame:
    @tidy
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = predict(model.value, batch.column(1).to_pylist())
                columns = [batch.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*found), list(PREDICTED_ARROW)[1:]))]
                yield pa.RecordBatch.from_arrays(columns, schema=PREDICTED_ARROW)

    return docs.select("doc_id", "text").mapInArrow(rows, PREDICTED)


def fit(labelled: DataFrame, train_rows: int = TRAIN_ROWS):
    """A broadcast model fitted on at most ``train_rows`` rows (doc_id, text, lang) per language, or of None."""
    spark = prepare(labelled.sparkSession)
    usable = labelled.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL AND lang <> ''").select("doc_id", "text", "lang")
    first = Window.partitionBy("lang").orderBy("key", "doc_id")
    chosen = (
        usable.select("doc_id", "lang", F.xxhash64("doc_id").alias("key"))
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= train_rows)
        .select("doc_id", "lang", "place")
        .dropDuplicates(["doc_id", "lang"])
    )
    sample = staged(usable.join(chosen, ["doc_id", "lang"]).dropDuplicates(["doc_id", "lang"]), "language-sample")
    held = F.col("place") % 4 == 0
    grams = sample.where(~held).select("lang", "text").mapInArrow(_gram_counts, GRAMS).groupBy("lang", "gram").agg(F.sum("count").alias("count"))
    found = grams.toArrow()
    if not len(found):
        return spark.sparkContext.broadcast(None)
    counts = {}
    for lang in pc.unique(found.column("lang")).to_pylist():
        part = found.filter(pc.equal(found.column("lang"), lang))
        data, _ = buffers(part.column("gram"))
        runs = np.frombuffer(data.tobytes().decode().encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, ORDER)
        counts[lang] = (runs, part.column("count").to_numpy())
    del found
    model = build(counts)
    langs = sample.select("doc_id", "lang").distinct()

    def tried() -> DataFrame:
        found = _predict_rows(sample.where(held), spark.sparkContext.broadcast(model)).where("symbols > 0")
        return found.join(langs, "doc_id").where("lang = lang_pred").groupBy("lang")

    size = F.sum("symbols")
    mean, squares = (F.sum(F.col(c) * F.col("symbols")) / size for c in ("cross_entropy", "squares"))
    for row in tried().agg(mean.alias("mean"), squares.alias("squares")).collect():
        model.limits[row["lang"]] = (row["mean"], float(np.sqrt(max(row["squares"] - row["mean"] ** 2, 0.0))), np.inf)
    for row in tried().agg(F.percentile("excess", F.array(F.lit(0.5), F.lit(UPPER))).alias("at")).collect():
        middle, upper = row["at"]
        model.limits[row["lang"]] = (*model.limits[row["lang"]][:2], max(0.0, middle + SPREADS * (upper - middle)))
    return spark.sparkContext.broadcast(model)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model) -> DataFrame:
    prepare(docs.sparkSession)
    return _predict_rows(docs, model).drop("squares", "excess")


def keep_identified(docs: DataFrame, model) -> DataFrame:
    """The documents whose language is recognised, all columns unchanged."""
    prepare(docs.sparkSession)
    text = docs.columns.index("text")

    @tidy
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = predict(model.value, batch.column(text).to_pylist())
            yield batch.filter(pa.array([not r[5] for r in found], pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out()))
    return identify(docs, model).withColumn("held_out", held_out())
