"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words, lower-cased, and the first 4, 6 and 8 bytes of longer ones, hashed to ``BITS`` bits. Its
score is the sigmoid of a bias, the weights of its terms and, for every pair of its terms, the product of their factor
vectors. So two terms that are harmless apart, such as an insult and the name of a group, can be harmful together, which
additive weights cannot say.

Learning, from at most about ``train_rows`` labelled rows (chosen by a hash of the id; every later step uses all of them):

1. Texts that are equal word by word and have the same label count once.
2. Terms of at least ``MIN_DOCS`` texts are tested for association with the label. Those whose likelihood ratio exceeds
   the logarithm of the number of terms tested stay; at most ``max_terms``, the best first.
3. Texts are folded to their kept terms, equal ones to one row with a count. On these, gradient steps over batches drawn by
   these counts, with a step size for each parameter (AdaGrad), fit weights and factors. Both have a normal prior around zero, of spread
   ``SPREAD`` and ``FACTOR_SPREAD``, so its pull fades as rows grow in number.

A pair whose terms say nothing apart (an exact exclusive-or) passes step 2 by chance only and is not learned.

Rows: NULL, empty and wordless texts have no term and get the score of the bias; rows without doc_id are scored and never
learned from; repeated rows get the same score; a label row without doc_id or label teaches nothing, of several labels for one doc_id
the highest counts; without any labelled row every score is 0; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import SortedHashes, buffers, letters_and_digits, located_words, mix, prepare, ragged, slices, staged

BITS = 30
TRAIN_ROWS = 100_000
MAX_TERMS = 4096
MIN_DOCS = 3
PREFIXES = (4, 6, 8)
FACTORS = 8
STEPS, BATCH = 1500, 512
RATE, FACTOR_RATE = 0.2, 0.04
SPREAD, FACTOR_SPREAD = 3.0, 0.5
THRESHOLD = 0.3

FEATURES = "label int, key_a long, key_b long, terms array<long>"


@dataclass
class Model:
    terms: SortedHashes  # hashed terms, cut to their leading BITS
    bias: float
    weights: np.ndarray
    factors: np.ndarray  # one row per term

    def logits(self, row: np.ndarray, term: np.ndarray, rows: int) -> np.ndarray:
        """``row`` and ``term`` list which text has which term, each pair once."""
        return _logits(self.bias, self.weights, self.factors, row, term, rows)[0]


def _logits(bias, weights, factors, row, term, rows):
    """Logits, and the sum of the factor vectors of each text."""
    sums = np.stack([np.bincount(row, factors[term, k], rows) for k in range(factors.shape[1])], axis=1)
    squares = np.bincount(row, (factors**2).sum(axis=1)[term], rows)
    return bias + np.bincount(row, weights[term], rows) + ((sums**2).sum(axis=1) - squares) / 2, sums


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def hashed(hashes: np.ndarray) -> np.ndarray:
    """Terms as hashes of which only the leading ``BITS`` are kept."""
    return hashes & ~np.uint64((1 << (64 - BITS)) - 1)


def terms_of(data: np.ndarray, offsets: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed terms of a slice and the text of each, repeats included; then the words' hashes and each text's first word."""
    found, begin, end, at = located_words(data, offsets, values)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    size = end - begin
    head = np.zeros(len(found), np.uint64)
    for k in range(max(PREFIXES)):
        byte = data[np.minimum(begin + k, max(len(data) - 1, 0))] if len(data) else np.empty(0, np.uint8)
        byte = np.where((byte >= 65) & (byte <= 90), byte + 32, byte).astype(np.uint64)
        head |= np.where(size > k, byte << np.uint64(8 * k), np.uint64(0))
    terms, rows = [hashed(found)], [row]
    for k in PREFIXES:
        longer = size > k
        cut = head[longer] & np.uint64((1 << (8 * k)) - 1)
        terms.append(hashed(mix(mix(cut) + np.uint64(k))))
        rows.append(row[longer])
    return np.concatenate(terms), np.concatenate(rows), found, at


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    values = letters_and_digits()
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        for first, last in slices(offsets):
            terms, rows, found, at = terms_of(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], values)
            order = np.lexsort((terms, rows))
            terms, rows = terms[order], rows[order]
            new = np.append(True, (terms[1:] != terms[:-1]) | (rows[1:] != rows[:-1]))[: len(terms)]
            terms, rows = terms[new], rows[new]
            # Equal runs of words have equal sums of their hashes mixed with their places.
            place = np.arange(len(found), dtype=np.uint64) - np.repeat(at[:-1], np.diff(at)).astype(np.uint64)
            mixed = mix(found + mix(place + np.uint64(1)))
            key_a = [mixed[a:b].sum(dtype=np.uint64) for a, b in zip(at[:-1], at[1:])]
            key_b = [np.bitwise_xor.reduce(mix(mixed[a:b]), initial=np.uint64(b - a)) for a, b in zip(at[:-1], at[1:])]
            bounds = np.searchsorted(rows, np.arange(last - first + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, last - first),
                    pa.array(np.array(key_a, np.uint64).view(np.int64)),
                    pa.array(np.array(key_b, np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(terms.view(np.int64))),
                ],
                ["label", "key_a", "key_b", "terms"],
            )


def sampled(labels: DataFrame, train_rows: int) -> DataFrame:
    """(doc_id, label) of at most about ``train_rows`` labelled ids, by a hash of the id."""
    known = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    share = train_rows / max(known.count(), 1)
    if share >= 1:
        return known
    return known.where(F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(1 << 40)) < int(share * (1 << 40)))


def _likelihood_ratio(n: int, positive: int) -> F.Column:
    """Twice the log likelihood ratio of label and term, from a term's texts and its positive texts."""

    def part(seen: F.Column, expected: F.Column) -> F.Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    share, with_term, hits = positive / n, F.col("n_docs").cast("double"), F.col("n_positive").cast("double")
    rest, missed = F.lit(float(n)) - with_term, F.lit(float(positive)) - hits
    return 2 * (
        part(hits, with_term * share)
        + part(with_term - hits, with_term * (1 - share))
        + part(missed, rest * share)
        + part(rest - missed, rest * (1 - share))
    )


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, max_terms: int = MAX_TERMS) -> Model | None:
    """A model of ``labels`` (doc_id, label: 0 or 1) over the texts of ``docs`` (doc_id, text)."""
    spark = prepare(docs.sparkSession)
    chosen = F.broadcast(sampled(labels, train_rows))  # about train_rows small rows at most
    rows = docs.where("doc_id IS NOT NULL").join(chosen, "doc_id").select(F.col("label").cast("int").alias("label"), "text")
    read = staged(rows.mapInArrow(_features, FEATURES).withColumn("row", F.monotonically_increasing_id()), "toxicity-features")
    first = read.groupBy("label", "key_a", "key_b").agg(F.min("row").alias("row")).select("row")
    kept = staged(read.join(first, "row", "left_semi").select("label", "terms"), "toxicity-texts")

    n, positive = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if n == 0:
        return None
    bias = float(np.log((positive + 0.5) / (n - positive + 0.5)))
    nothing = Model(SortedHashes(np.empty(0, np.uint64)), bias, np.empty(0), np.empty((0, FACTORS)))
    if positive in (0, n):
        return nothing
    counts = kept.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("label").alias("n_positive"))
    tested = staged(counts.where(F.col("n_docs") >= MIN_DOCS).withColumn("ratio", _likelihood_ratio(n, positive)), "toxicity-terms")
    bound = float(np.log(max(tested.count(), 2)))
    best = tested.where(F.col("ratio") >= bound).orderBy(F.desc("ratio"), "term").limit(max_terms).select("term").collect()
    if not best:
        return nothing
    terms = SortedHashes(np.sort(np.array([r["term"] for r in best], np.int64).view(np.uint64)))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            at = np.asarray(lists.offsets)
            place = terms.find(lists.values.to_numpy().view(np.uint64)[at[0] : at[-1]])
            found = place >= 0
            bounds = np.append(0, np.cumsum(found))[at - at[0]].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(bounds), pa.array(place[found]))], ["label", "terms"])

    folded = kept.mapInArrow(fold, "label int, terms array<int>").groupBy("label", "terms").agg(F.count(F.lit(1)).alias("texts"))
    table = folded.orderBy("terms", "label").toArrow()  # at most one small row per training text
    lists = table.column("terms").combine_chunks()
    at = np.asarray(lists.offsets)
    term = lists.values.to_numpy()[at[0] : at[-1]]
    row = np.repeat(np.arange(len(table)), np.diff(at))
    label, weight = (table.column(c).to_numpy().astype(float) for c in ("label", "texts"))
    return _train(terms, bias, row, term, label, weight)


def _train(terms: SortedHashes, bias: float, row: np.ndarray, term: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Model:
    """``row`` ascends; ``weight`` is how many texts a row stands for. The work is set by ``STEPS`` and ``BATCH``, not by the rows."""
    count, rows, texts = len(terms.keys), len(label), weight.sum()
    shrink, factor_shrink = 1 / (texts * SPREAD**2), 1 / (texts * FACTOR_SPREAD**2)
    draw = np.random.default_rng(12)
    weights, factors = np.zeros(count), draw.normal(0, 0.01, (count, FACTORS))
    seen_w, seen_f, seen_b = np.full(count, 1e-12), np.full((count, FACTORS), 1e-12), 1e-12
    mean_w, mean_f, mean_b = np.zeros(count), np.zeros((count, FACTORS)), 0.0
    begin, upto = np.searchsorted(row, np.arange(rows + 1)), np.cumsum(weight)
    for step in range(STEPS):
        if texts <= BATCH:
            chosen, share = np.arange(rows), weight / texts
        else:
            chosen, times = np.unique(np.searchsorted(upto, draw.random(BATCH) * texts, side="right"), return_counts=True)
            share = times / BATCH
        sizes = begin[chosen + 1] - begin[chosen]
        of_row, of_term = np.repeat(np.arange(len(chosen)), sizes), term[ragged(begin[chosen], sizes)]
        logits, sums = _logits(bias, weights, factors, of_row, of_term, len(chosen))
        slope = (sigmoid(logits) - label[chosen]) * share
        by_term = np.bincount(of_term, slope[of_row], count)
        by_w = by_term + shrink * weights
        by_f = np.stack([np.bincount(of_term, (slope * sums[:, k])[of_row], count) for k in range(FACTORS)], axis=1)
        by_f += (factor_shrink - by_term[:, None]) * factors
        by_b = slope.sum()
        seen_w, seen_f, seen_b = seen_w + by_w**2, seen_f + by_f**2, seen_b + by_b**2
        weights = weights - RATE * by_w / np.sqrt(seen_w)
        factors = factors - FACTOR_RATE * by_f / np.sqrt(seen_f)
        bias -= RATE * by_b / np.sqrt(seen_b)
        if 2 * step >= STEPS:  # the mean of the later half evens out what single batches do
            mean_w, mean_f, mean_b = mean_w + weights, mean_f + factors, mean_b + bias
    later = STEPS - (STEPS + 1) // 2
    return Model(terms, float(mean_b / later), mean_w / later, mean_f / later)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, n_terms): the probability of label 1 for every row, and how many of its distinct terms the model knows."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # max_terms rows at most

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = letters_and_digits()
        learned = shared.value
        for batch in batches:
            out, known = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            data, offsets = buffers(batch.column(1))
            for first, last in slices(offsets) if learned else ():
                terms, row, _, _ = terms_of(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], values)
                place = learned.terms.find(terms)
                hit = np.flatnonzero(place >= 0)
                width = max(len(learned.terms.keys), 1)
                pairs = np.unique(row[hit] * width + place[hit])
                out[first:last] = sigmoid(learned.logits(pairs // width, pairs % width, last - first))
                known[first:last] = np.bincount(pairs // width, minlength=last - first)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out), pa.array(known)], ["doc_id", "score", "n_terms"])

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, score double, n_terms long")


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    model = fit(docs, labels.select("doc_id", F.col("toxic").alias("label")))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"), "n_terms")
