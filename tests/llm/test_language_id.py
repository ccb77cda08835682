import os

import numpy as np
import pytest
from rosterline.llm import language_id
from rosterline.llm.language_id import ORDER

MIDDLE = "/root/testdata/sf0.01"
EN = "the quick brown fox jumps over the lazy dog and then they went home with the others "
DE = "der schnelle braune fuchs springt über den faulen hund und dann gingen sie nach hause "


@pytest.fixture(scope="module")
def model(spark):
    rows = [(k, (EN if k % 2 else DE) * (1 + k % 3), "en" if k % 2 else "de", "s", 0) for k in range(40)]
    rows += [(None, "xyz" * 20, "xx", "s", 0), (90, None, "yy", "s", 0), (91, "zzz zzz", None, "s", 0), (92, "qqq", "", "s", 0), (1, EN, "en", "s", 0)]
    return language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def test_edges(spark, docs, model):
    rows = [(1, None), (2, ""), (3, "123 !? \n"), (4, EN.upper()), (5, DE), (6, EN * 6000), (6, EN * 6000), (7, "д ж щ ъ э ю я " * 30), (None, DE)]
    found = language_id.identify(docs(rows), model).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == len(rows) and model.value.languages == ["de", "en"]
    for k in (1, 2, 3):
        assert (by_id[k]["lang_pred"], by_id[k]["score"], by_id[k]["rejected"]) == ("und", 0.0, True)
    assert [by_id[k]["lang_pred"] for k in (4, 5, 6, None)] == ["en", "de", "en", "de"]
    assert by_id[7]["rejected"] and not any(by_id[k]["rejected"] for k in (4, 5, 6, None))
    assert all(0 <= r["score"] <= 1 for r in found)
    kept = language_id.keep_identified(docs(rows).selectExpr("*", "'x' AS lang_pred", "1 AS score"), model)
    assert kept.columns[-2:] == ["lang_pred", "score"] and sorted(str(r["doc_id"]) for r in kept.collect()) == ["4", "5", "6", "6", "None"]
    assert language_id.identify(docs([]), model).count() == 0


def test_without_labels_every_text_is_undetermined(docs):
    model = language_id.fit(docs([(1, "some text")]))
    assert model.value is None
    assert [r["lang_pred"] for r in language_id.identify(docs([(1, "some text")]), model).collect()] == ["und"]


def test_distributions_sum_to_one(model):
    known = model.value
    alphabet = np.unique(np.concatenate([known_symbols(known), [32]]))
    for context in ("   ", " th", "der", "xxx", "the"):
        head = [ord(c) for c in context[-(ORDER - 1):]]
        total = np.zeros(len(known.languages))
        for symbol in alphabet:
            total += np.exp(known.log_probabilities(np.array([*head, symbol], np.uint32))[0])
        unseen = np.exp(known.log_probabilities(np.array([*head, 0x4E2D], np.uint32))[0])
        assert np.allclose(total + unseen, 1, atol=1e-4)


def known_symbols(model):
    return np.array([ord(c) for c in sorted(set(EN + DE))], np.uint32)


def test_symbols_keep_texts_apart():
    stream, at = language_id.symbols(["Ab, c", None, "1", "\nDe\n"])
    texts = ["".join(map(chr, stream[a:b])) for a, b in zip(at[:-1], at[1:])]
    assert texts == ["   ab c ", "", "", "   de "]


def test_held_out_accuracy(small_tables):
    docs = small_tables("documents")
    found = language_id.identify(docs, language_id.fit(docs.where(~language_id.held_out()))).withColumn("held_out", language_id.held_out())
    rows = found.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 20 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95 and not any(r["rejected"] for r in rows)


def test_a_language_left_out_is_rejected_and_mixed_texts_stay(spark):
    if not os.path.isdir(MIDDLE):
        pytest.skip("given tables are not here")
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").where("length(text) > 400")
    texts = {}
    for r in docs.where(language_id.held_out()).select("lang", "text").collect():
        texts.setdefault(r["lang"], []).append(r["text"])
    known = language_id.fit(docs.where(~language_id.held_out())).value
    mixed = [a[:400] + " " + b[:400] for a in texts["en"] for lang in texts if lang != "en" for b in texts[lang][:2]]
    assert mixed and not any(r[5] for r in language_id.predict(known, mixed))
    for lang in ("en", "de"):
        without = language_id.fit(docs.where(~language_id.held_out()).where(docs["lang"] != lang)).value
        assert np.mean([r[5] for r in language_id.predict(without, texts[lang])]) > 0.9
