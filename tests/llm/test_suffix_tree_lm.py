import math
import re
import zlib
from collections import Counter

import pytest
from rosterline.llm import suffix_tree_lm as lm

WORD = re.compile("[^\x20\x09-\x0d]+")
BEGIN, END = "<begin>", "<end>"  # no words: the texts hold none of these


def tokens(text):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), END]


class SlowTree:
    """The same suffix tree from dictionaries of word tuples."""

    def __init__(self, texts):
        self.counts = Counter(t for text in texts for t in tokens(text))
        self.n, self.v = sum(self.counts.values()), len(self.counts)
        self.tree = {}  # context -> (share left to the suffix, explicit probabilities)
        streams = [[BEGIN, *tokens(text)] for text in texts]
        for depth in range(1, lm.DEPTH + 1):
            follow = {}
            for s in streams:
                for i in range(depth, len(s)):
                    follow.setdefault(tuple(s[i - depth : i]), Counter())[s[i]] += 1
            found = {}
            for context, after in follow.items():
                seen = sum(after.values())
                explicit = {x: c for x, c in after.items() if c >= lm.LEAST_ARC}
                if seen < lm.LEAST_CONTEXT or not explicit:
                    continue
                left = 1 - sum(c - lm.DISCOUNT for c in explicit.values()) / seen
                p = {x: (c - lm.DISCOUNT) / seen + left * self.p(context[1:], x) for x, c in explicit.items()}
                gain = sum(c * math.log10(p[x] / self.p(context[1:], x)) for x, c in explicit.items())
                gain += (seen - sum(explicit.values())) * math.log10(left)
                if gain > 0.5 * len(explicit) * math.log10(seen):
                    found[context] = (left, p)
            self.tree |= found

    def p(self, context, x):
        if not context:
            return (self.counts[x] + 1) / (self.n + self.v + 1)
        if context not in self.tree:
            return self.p(context[1:], x)
        left, p = self.tree[context]
        return p[x] if x in p else left * self.p(context[1:], x)

    def row(self, i, text):
        s = [BEGIN, *tokens(text)]
        score = sum(math.log10(self.p(tuple(s[max(0, k - lm.DEPTH) : k]), s[k])) for k in range(1, len(s)))
        base = sum(math.log10(self.p((), x)) for x in s[1:])
        return i, len(s) - 1, sum(self.counts[x] > 0 for x in s[1:]), self.n, base, score


ROWS = [(k, " ".join(["Alpha beta gamma", "delta", "alpha beta"][: 1 + k % 3] * (2 + k % 4)) + f" rare{k}") for k in range(60)]
ROWS += [(k, f"one of {'two' if k % 2 else 'three'} words ends {'here' if k % 2 else 'there'}") for k in range(200, 260)]
ROWS += [(100, None), (101, ""), (102, "unknown words only"), (103, "alpha " * 30000), (None, "Alpha beta"), (7, ROWS[7][1])]


@pytest.mark.parametrize("hot_keys", [1 << 20, 3, 0])
def test_scores_equal_those_of_a_slow_tree(docs, monkeypatch, hot_keys):
    monkeypatch.setattr(lm, "HOT_KEYS", hot_keys)
    table = docs(ROWS).selectExpr("*", "1 AS score", "2 AS row", "3 AS key", "4 AS n")
    slow = SlowTree([text for i, text in ROWS if i is None or zlib.crc32(str(i).encode()) % 7 != 2])
    model = lm.fit(table.where(~lm.held_out()))
    found = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in lm.score(table, model).collect()]
    assert len(found) == len(ROWS)
    for got, want in zip(sorted(found, key=str), sorted((slow.row(*r) for r in ROWS), key=str)):
        assert got[:4] == want[:4] and got[4:] == pytest.approx(want[4:], rel=1e-9, abs=1e-6)
    assert {len(c) for c in slow.tree} == {1, 2, 3} and any(c[0] == BEGIN for c in slow.tree)
    for context in [(), ("nothing",), *slow.tree]:  # all words and one unknown word
        assert sum(slow.p(context, x) for x in [*slow.counts, "never-seen"]) == pytest.approx(1)


def test_a_full_bitmap_changes_no_score(docs, monkeypatch):
    def scores():
        return sorted(lm.score(docs(ROWS), lm.fit(docs(ROWS))).select("doc_id", "score").collect(), key=str)

    monkeypatch.setattr(lm, "HOT_KEYS", 3)
    wanted = scores()
    monkeypatch.setattr(lm, "BITS", 7)
    for got, want in zip(scores(), wanted):
        assert got["doc_id"] == want["doc_id"] and got["score"] == pytest.approx(want["score"], rel=1e-9)


def test_the_tree_grows_with_the_corpus(docs):
    """Words and transitions that a small corpus keeps are kept in one forty times as large, beside all others."""

    def texts(first, last):
        return [(k, f"start{k // 20} then{k // 20} stop{k // 20}") for k in range(first, last)]

    small, large = (lm.fit(docs(texts(0, n))) for n in (400, 16000))
    keys = [{r["key"] for r in m.values.select("key").collect()} for m in (small, large)]
    assert keys[0] <= keys[1] and len(keys[1]) > 30 * len(keys[0]) > 0


def test_nothing_to_learn_from(docs):
    model = lm.fit(docs([]))
    found = lm.score(docs([(1, "a b"), (2, None)]), model).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in found) == [(1, 3, 0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0)]
    assert lm.score(docs([]), model).count() == 0


def test_what_moves_between_tasks_is_a_few_packed_rows(docs, spark, monkeypatch):
    """Sequences leave a task as packed columns, and a small table has few buckets whatever the partitions."""
    monkeypatch.setattr(lm, "HOT_KEYS", 0)
    table = docs([(k, " ".join(f"w{k % 7 * j}" for j in range(400))) for k in range(200)]).repartition(2).cache()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 300)
        model = lm.fit(table)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    shared, buckets = spark.sparkContext.broadcast(lm.hot(model)), model.buckets
    moved = table.select("doc_id", "text").mapInArrow(lambda b: lm._score(b, shared, buckets), lm.MESSAGE)
    size, rows = moved.selectExpr("sum(octet_length(data))", "count(*)").first()
    assert rows < 100 and size > 16 * 10000 and model.tree.count() < 1000 < model.values.count()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_packed_columns_come_back():
    columns = [lm.np.array([], int), lm.np.array([1.5, -2.0, 0.0]), lm.np.array([-1, 2**62, 3])]
    assert lm.unpack(lm.pack(columns[0]), 1).shape == (1, 0)
    found = lm.unpack(lm.pack(*columns[1:]), 2)
    assert found[0].view(float).tolist() == columns[1].tolist() and found[1].view(int).tolist() == columns[2].tolist()
