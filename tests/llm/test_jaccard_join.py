import os
import re
import subprocess
import sys
import time
from itertools import combinations

import numpy as np
import pytest
from llm_helpers import number_words
from rosterline.llm import jaccard_join
from rosterline.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4)) if len(found) >= 5 else frozenset([tuple(found)] if found else [])


def brute_force(rows):
    """(doc_id, set size, smallest reachable id) by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {(i, len(sets[i]), find(i)) for i in sets}


def result(df):
    found, _ = jaccard_join.link(df)
    return [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()]


def test_like_brute_force_with_copies_chains_and_shared_passages(docs):
    rng = np.random.default_rng(3)
    passage = number_words(0, 60)
    rows, next_id = [], 0
    for group in range(6):
        base = number_words(1000 + 400 * group, int(rng.integers(30, 300)))
        for copy in range(int(rng.integers(2, 9))):
            words = list(base)
            for _ in range(copy % 4):
                words[int(rng.integers(len(words)))] = f"x{next_id}"
            rows.append((next_id, " ".join(words)))
            next_id += 1
    for k in range(20):  # one passage that many documents share
        rows.append((next_id, " ".join([*number_words(5000 + 40 * k, 30), *passage, *number_words(6000 + 40 * k, 30)])))
        next_id += 1
    base = number_words(8000, 140)
    for copy in range(25):  # copies of one text, from near to far
        words = list(base)
        for place in rng.integers(0, 140, copy // 3):
            words[place] = f"y{next_id}z{place}"
        rows.append((next_id, " ".join(words)))
        next_id += 1
    for k in range(12):  # nothing but shared passages
        rows.append((next_id, " ".join([*passage, *passage[: 10 + 4 * k]])))
        next_id += 1
    chain = number_words(9000, 120)
    for k in range(8):  # neighbours are similar, ends are not
        rows.append((next_id, " ".join(chain[2 * k : 2 * k + 60])))
        next_id += 1
    assert set(result(docs(rows))) == brute_force(rows)


def test_edges(docs):
    long_text = " ".join(number_words(0, 9000) * 3)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one\ttwo"), (6, "two one"), (7, long_text), (8, long_text + " end")]
    expected = brute_force(rows)
    assert {(1, 0, 1), (4, 1, 4), (5, 1, 4), (6, 1, 6), (8, 0, 8)} - expected == {(8, 0, 8)}
    rows += [(None, "a b c d e f"), (11, "a b c d e f"), (11, "a b c d e f"), (12, "A B C D E F"), (13, "k l m n o p"), (13, "q r s t u v"), (14, "q r s t u v")]
    found = result(docs(rows))
    assert {r for r in found if r[0] is not None and r[0] < 10} == expected
    assert [r for r in found if r[0] is None] == [(None, 2, None)]
    assert sorted(r for r in found if r[0] in (11, 12)) == [(11, 2, 11), (12, 2, 11)]
    assert sorted(r for r in found if r[0] in (13, 14)) == [(13, 2, 13), (13, 2, 13), (14, 2, 13)]  # one row for each text
    assert result(docs([])) == []


def test_keep_first_keeps_one_of_each_component_and_all_columns(docs):
    rows = [(3, "a b c d e f", "en", "s"), (2, "a b c d e f", "de", "t"), (9, "other words that stand alone here", "en", "s"), (None, "a b c d e f", "en", "s"), (5, None, "en", "s")]
    kept = jaccard_join.keep_first(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted((r["doc_id"], r["lang"]) for r in kept.where("doc_id IS NOT NULL").collect()) == [(2, "de"), (5, "en"), (9, "en")]
    assert kept.where("doc_id IS NULL").count() == 1
    clash = docs(rows).selectExpr("*", "1 AS component", "2 AS sig", "3 AS a", "4 AS size")
    assert jaccard_join.keep_first(clash).columns == clash.columns and jaccard_join.keep_first(clash).count() == 4


def test_shuffle_files_go_with_their_query(docs, spark):
    """None of the join's many queries leaves its shuffle files to the driver's garbage collector."""

    def kept():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        names = set()
        while blocks.hasNext():
            names.add(blocks.next().getName())
        return {x for x in names if x.startswith("shuffle_")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    table = docs([(k, " ".join(number_words(50 * (k // 3), 40 + k % 3))) for k in range(30)])
    before = kept(), spark.conf.get(setting)
    found, links = jaccard_join.link(table)
    deadline = time.monotonic() + 20
    while not kept() <= before[0] and time.monotonic() < deadline:  # files go in the background
        time.sleep(0.1)
    assert kept() <= before[0] and spark.conf.get(setting) == before[1]
    first = sorted(found.collect())
    assert len(first) == 30 and first == sorted(found.collect()) and {r["component_id"] for r in first} == set(range(0, 30, 3))
    assert links.count() == links.count() > 0


def test_parity_never_rules_out_a_similar_pair():
    rng = np.random.default_rng(5)
    for _ in range(300):
        size = int(rng.integers(1, 400))
        a = rng.integers(0, 1 << 63, size).astype(np.uint64)
        b = np.concatenate([a[: size - int(rng.integers(0, max(1, size // 10) + 1))], rng.integers(0, 1 << 63, int(rng.integers(0, size // 10 + 1))).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        assert jaccard_join.parity_distance(jaccard_join.parity(a), jaccard_join.parity(b)) <= len(np.setxor1d(a, b))


def test_similar_sizes_share_the_band_of_the_smaller_one():
    for a in range(1, 5000):
        own = jaccard_join.bands(a)[0]
        assert jaccard_join.lower_end(own) <= a < jaccard_join.lower_end(own + 1) or jaccard_join.lower_end(own + 1) == jaccard_join.lower_end(own)
        for b in {a, a * 9 // 8, a * 5 // 4}:
            assert own in jaccard_join.bands(b)
        assert len(jaccard_join.bands(a)) <= 2


def similar_pair(rng, size, spread=1.0):
    """Two sets of a similarity just above 0.8; ``spread`` below 1 takes their hashes from a part of the domain."""
    every = np.unique(rng.integers(0, int(spread * (1 << 62)), 3 * size).astype(np.uint64))
    rng.shuffle(every)
    k = jaccard_join.largest_difference(size)
    more = int(rng.integers(0, size // 4 + 1))
    less = max(0, (k - more) // 2)
    a = every[:size]
    b = np.concatenate([every[less:size], every[size : size + less + more]])
    while 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)):
        b = b[:-1] if len(b) > len(a) else np.union1d(a[:1], b) if a[0] not in b else np.union1d(b, a)
    return np.unique(a), np.unique(b)


def rarest(found, spare, order):
    return set(sorted(found.tolist(), key=lambda s: (order.get(s, 0), s), reverse=True)[spare:])


def test_similar_sets_share_a_kept_signature_whatever_is_rare():
    rng = np.random.default_rng(7)
    for size in [*range(1, 70), 90, 128, 150, 181, 255, 256, 300, 362, 500, 724, 1000, 3000]:
        for _ in range(6):
            a, b = similar_pair(rng, size)
            small = min(a, b, key=len)
            band = jaccard_join.bands(len(small))[0]
            (of_a, spare_a), (of_b, spare_b) = (jaccard_join.signed_and_spare(x, band) for x in (a, b))
            assert spare_a >= 0 and spare_b >= 0
            both = np.intersect1d(of_a, of_b)
            crowded = {s: 1 for s in both.tolist()}  # the worst order: all that they share is crowded
            assert rarest(of_a, spare_a, crowded) & rarest(of_b, spare_b, crowded), (size, len(a), len(b))


def test_no_more_is_spoiled_than_stated():
    rng = np.random.default_rng(9)
    for size in (12, 30, 60, 120, 250, 400, 900):
        band = jaccard_join.bands(size)[0]
        salt, (partitions, cells) = np.uint64(5), jaccard_join.cut(band)
        for _ in range(40):
            a = np.unique(rng.integers(0, 1 << 62, size).astype(np.uint64))
            k = jaccard_join.largest_difference(len(a))
            b = np.append(a, rng.integers(1 << 62, 1 << 63, k).astype(np.uint64))
            of_a, of_b = (jaccard_join._subsets(x, jaccard_join.mix(x), salt, partitions, cells)[0] for x in (a, b))
            assert len(np.setdiff1d(of_a, of_b)) <= jaccard_join.spoiled(len(a), partitions, cells)


def test_sets_in_few_cells_sign_every_shingle():
    rng, band = np.random.default_rng(8), jaccard_join.bands(600)[0]
    partitions, cells = jaccard_join.cut(band)
    assert cells == 1
    salt = np.uint64((band + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    every = rng.integers(0, 1 << 63, 200_000).astype(np.uint64)
    part = jaccard_join.mix(every ^ salt) % np.uint64(partitions)
    crowded = every[part < 3][:600]
    a, b = np.unique(crowded[:590]), np.unique(crowded[20:])
    (of_a, spare_a), (of_b, spare_b) = (jaccard_join.signed_and_spare(x, band) for x in (a, b))
    assert spare_a == spare_b == 0 and len(np.intersect1d(of_a, of_b))


def test_three_hundred_just_below_the_limit(docs):
    """Documents that share 0.75 of their shingles by pairs, beside a few that are above 0.8."""
    rng = np.random.default_rng(12)
    base = number_words(0, 400)
    rows = []
    for k in range(300):
        words = list(base)
        for place in rng.choice(390, 10, replace=False):
            words[place] = f"own{k}at{place}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, rows[7 * k][1].replace(f"own{7 * k}", "other", 2)) for k in range(20)]
    found = set(result(docs(rows)))
    assert found == brute_force(rows)
    assert len({c for *_, c in found}) > 100


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (300, 200), (200, 300)]
    found = {tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {(i, 0) for i in range(41)} | {(i, 100) for i in range(100, 140)} | {(200, 200), (300, 200)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


HELD_AFTER_A_TASK = """
import re, sys
import numpy as np, pyarrow as pa
from rosterline.llm import jaccard_join

def held():
    return sum(map(int, re.findall(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

def batches():
    rng = np.random.default_rng(7)
    for k in range(6):
        texts = [" ".join(map(str, rng.integers(0, 1 << 40, 150))) for _ in range(1000)]
        yield pa.RecordBatch.from_pydict({"doc_id": list(range(1000 * k, 1000 * k + 1000)), "text": texts})

for _ in batches():
    pass
before = held()
for _ in jaccard_join._sets(batches()):
    pass
print(held() - before)
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="needs the memory figures of Linux")
def test_a_worker_holds_little_after_its_task():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    run = subprocess.run([sys.executable, "-c", HELD_AFTER_A_TASK], capture_output=True, text=True, cwd=root, env=os.environ | {"PYTHONPATH": root}, check=True)
    assert float(run.stdout) < 12  # 25 to 27 before memory was given back
