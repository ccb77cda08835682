import zlib

import numpy as np
import pytest
from rosterline.llm import token_output
from rosterline.llm.common import file_system
from rosterline.session import fresh_path

ROWS = [
    (5, "Hello, World! it's 2024 — naïve café ÀÉ ß İstanbul Σας x=3.14"),
    (2, None), (3, ""), (4, " \n\t"), (None, "no id here"), (9, "word " * 30000), (9, "word " * 30000),
    (7, "line one line two\x1cend <|endoftext|> é don't DON'T!!! 中文 字"), (-4, "minus"),
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_output.tokenizer_file())


def expected(rows, tokenizer):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def result(df):
    found = token_output.write_and_read(df, token_output.tokenizer_file())
    return sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in found.collect()), key=lambda r: r[1])


def test_round_trip(docs, tokenizer):
    assert result(docs(ROWS)) == expected(ROWS, tokenizer)
    assert result(docs([])) == []
    assert result(docs(ROWS).selectExpr("*", "1 AS shard", "2 AS start", "3 AS n_tokens").repartition(5)) == expected(ROWS, tokenizer)


def test_given_documents(small_tables, tokenizer):
    docs = small_tables("documents")
    assert result(docs) == expected([(r["doc_id"], r["text"]) for r in docs.collect()], tokenizer)


def test_shuffled_read_and_damage(spark, docs, tokenizer):
    folder = fresh_path(spark, "records")
    shards = token_output.write_records(docs(ROWS).where("doc_id IS NOT NULL"), folder, token_output.tokenizer_file()).collect()
    path = shards[0]["path"]
    stream, width, offsets = token_output.open_shard(path)
    for place in reversed(range(shards[0]["records"])):
        doc_id, ids = token_output.read_record(stream, int(offsets[place]), width)
        assert ids[-1] == 1
    assert sum(s["records"] for s in shards) == len(ROWS) - 1
    fs, local = file_system(f"{path}.rec")
    with fs.open_input_file(local) as whole:
        raw = bytearray(whole.read())
    raw[int(offsets[-1]) - 6] ^= 1
    with fs.open_output_stream(local) as out:
        out.write(bytes(raw))
    stream, width, offsets = token_output.open_shard(path)
    with pytest.raises(ValueError, match="damaged"):
        token_output.read_record(stream, int(offsets[-2]), width)


def test_the_memory_of_words_may_start_anew(monkeypatch, tokenizer):
    monkeypatch.setattr(token_output, "CACHED_WORDS", 3)
    encoder = token_output.WordEncoder(token_output.tokenizer_file())
    text = " ".join(f"Word{k}, and {k}" for k in range(50))
    for part in (text[:60].rsplit(" ", 1)[0], text, "Word1, new", text):
        assert encoder.encode(part.encode()).tolist() == tokenizer.encode(part, add_special_tokens=False).ids
