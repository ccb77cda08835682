import re

import numpy as np
from llm_helpers import number_words
from rosterline.llm import decontamination
from rosterline.llm.decontamination import SuffixArray

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(rows, items):
    windows = {}
    for item, text in items:
        found = words(text)
        size = min(10, len(found))
        if size and item is not None:
            for k in range(len(found) - size + 1):
                windows.setdefault(tuple(found[k : k + size]), set()).add(str(item))
    out = []
    for doc_id, text in rows:
        found, seen = words(text), set()
        hit = [False] * len(found)
        for size in {len(w) for w in windows}:
            for k in range(len(found) - size + 1):
                of = windows.get(tuple(found[k : k + size]))
                if of:
                    seen |= of
                    hit[k : k + size] = [True] * size
        out.append((doc_id, len(found), sum(hit), len(seen), sorted(seen)))
    return sorted(out, key=str)


def scanned(df, items):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items"]) for r in decontamination.scan(df, items).collect()), key=str)


def test_like_brute_force(spark, docs):
    rng = np.random.default_rng(1)
    passages = [number_words(100 * k, 25) for k in range(5)]
    items = [(k, " ".join(p)) for k, p in enumerate(passages)]
    items += [(7, "Tiny item"), (8, "one"), (9, None), (10, " .,"), (None, " ".join(passages[0])), (11, " ".join(passages[1])), (1, "other words for item one")]
    rows = [(1, None), (2, ""), (3, "no hit"), (4, "a TINY, item! One more"), (5, " ".join(passages[2] * 3)), (6, " ".join(number_words(3000, 7000) + passages[0][3:14])), (6, " ".join(passages[1]))]
    for k in range(40):
        text = number_words(int(rng.integers(0, 400)), int(rng.integers(0, 60)))
        rows.append((100 + k, ", ".join(text)))
    table = spark.createDataFrame(items, "item_id long, text string")
    assert scanned(docs(rows), table) == brute_force(rows, items)
    assert scanned(docs([]), table) == []
    assert scanned(docs(rows), table.limit(0)) == brute_force(rows, [])
    clash = docs(rows).selectExpr("*", "1 AS n_hit", "2 AS items")
    kept = decontamination.decontaminate(clash, table)
    clean = sorted(str(r[0]) for r in brute_force(rows, items) if not r[2])
    assert kept.columns == clash.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == clean


def test_longest_matches_and_their_places(spark, docs):
    passage = number_words(0, 30)
    text = " ".join([*number_words(500, 4), *passage[5:25], *number_words(600, 3)])
    found = decontamination.scan(docs([(1, text)]), spark.createDataFrame([(3, " ".join(passage))], "item_id long, text string")).first()
    assert found["longest"] == 20 and [tuple(m) for m in found["matches"]] == [("3", 5, 4, 20)]


def test_suffixes_are_sorted_in_full_depth():
    rng = np.random.default_rng(2)
    for size in (1, 2, 50, 400):
        data = rng.integers(1, 4, size).astype(np.uint64)
        order = SuffixArray(data, size).order
        expected = sorted(range(size), key=lambda i: tuple(data[i:].tolist()))
        assert order.tolist() == expected


def test_segments_of_a_long_slice_agree(spark, docs, monkeypatch):
    passage = number_words(0, 40)
    text = " ".join(number_words(100, 90) + passage + number_words(300, 90))
    whole = decontamination._scan_slice([1], *one_slice(text), *stored(spark, passage))
    monkeypatch.setattr(decontamination, "SEGMENT_WORDS", 37)
    assert decontamination._scan_slice([1], *one_slice(text), *stored(spark, passage)) == whole


def one_slice(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return decontamination.words(raw, np.array([0, len(raw)]), decontamination.letters_and_digits())


def stored(spark, passage):
    return decontamination.store_benchmark(spark.createDataFrame([(1, " ".join(passage))], "item_id long, text string")).removeprefix("file:"), 10
