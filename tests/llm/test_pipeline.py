"""Every stage of the pipeline against a brute-force version, on all that its predecessor kept."""

import os

import duckdb
import pytest
import test_decontamination
import test_jaccard_join
import test_token_output
from rosterline.llm import language_id, mixing

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="given tables are not here")
def test_stages(spark, small_tables):
    from tokenizers import Tokenizer

    docs = small_tables("documents")
    outputs = [docs]
    for _, stage in corpus_pipeline.STAGES:
        outputs.append(corpus_pipeline.staged(stage(spark, outputs[-1], SMALL), "test-stage"))
    texts = [{r["doc_id"]: r["text"] for r in df.collect()} for df in outputs[:-1]]
    assert all(df.columns == docs.columns for df in outputs[:-1])
    given, known, single, clean, mixed = texts

    model = language_id.fit(docs.where(~language_id.held_out()))
    rejected = {r["doc_id"] for r in language_id.identify(docs, model).collect() if r["rejected"]}
    assert set(known) == set(given) - rejected
    assert {i for i, t in given.items() if not any(c.isalpha() for c in t or "")} <= rejected

    kept = {i for i, _, component in test_jaccard_join.brute_force(list(known.items())) if i == component}
    assert set(single) == kept

    items = [(r["item_id"], r["text"]) for r in small_tables("benchmark").collect()]
    assert set(clean) == {r[0] for r in test_decontamination.brute_force(list(single.items()), items) if not r[2]}

    with duckdb.connect() as duck:
        duck.register("documents", outputs[3].toArrow())
        chosen = duck.sql(mixing.oracle(share=corpus_pipeline.MIX_SHARE, epochs=1)).fetchall()
    assert set(mixed) == {r[0] for r in chosen} and 0 < len(mixed) < len(clean)

    tokenizer = Tokenizer.from_file(test_token_output.token_output.tokenizer_file())
    found = sorted((tuple(r) for r in outputs[-1].select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])
    assert found == test_token_output.expected(list(mixed.items()), tokenizer)
