"""Token alignment against a slow reading of its definition."""

import base64
import hashlib
import random
from collections import Counter

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from rosterline.llm import alignment  # noqa: E402

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    "The quick brown fox, isn't it?",
    "The quick brown fox, isn't it?",
    "  two  spaces\n\n\tand tabs \n",
    "naïve café Ærøskøbing ñandú",
    "日本語のテキスト и кириллица 🙂🙂",
    "<|endoftext|> and <s> </s> <unk> <0x41> ▁ as text",
    "don't we'll I'VE 12345 3.14 $$$ %%% a1b2",
    "",
    None,
    " ",
    "x",
    "word " * 3000,
    "a\x00b\x1cc\x85d e f",
    "ﬁ ½ é ①",
]


def tokens(text):
    """Ids and byte strings of both tokenizers, read token by token; None where they do not give back the text."""
    import sentencepiece
    from tokenizers import Tokenizer

    if not text:
        return None
    tool = Tokenizer.from_file(A)
    tool.encode_special_tokens = True
    signs = alignment.byte_of_sign()
    ids_a = tool.encode(" " + text, add_special_tokens=False).ids
    bytes_a = [bytes(signs[c] for c in tool.id_to_token(i)) for i in ids_a]
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    ids_b = pieces.encode(text)
    bytes_b = []
    for i in ids_b:
        piece = pieces.id_to_piece(i)
        hexed = piece.startswith("<0x") and piece.endswith(">") and len(piece) == 6
        bytes_b.append(bytes.fromhex(piece[3:5]) if hexed else piece.replace("▁", " ").encode())
    wanted = (" " + text).encode()
    if b"".join(bytes_a) != wanted or b"".join(bytes_b) != wanted:
        return None
    return ids_a, bytes_a, ids_b, bytes_b


def spans(parts):
    out, at = [], 0
    for part in parts:
        out.append((at, at + len(part)))
        at += len(part)
    return out


def slow(texts):
    """n_a, n_b, n_groups, n_links, n_best, count_sum, digest of each text."""
    made = []
    for text in texts:
        found = tokens(text)
        if found is None:
            made.append((0, 0, 0, "", Counter()))
            continue
        ids_a, bytes_a, ids_b, bytes_b = found
        span_a, span_b = spans(bytes_a), spans(bytes_b)
        cuts = sorted({e for _, e in span_a} & {e for _, e in span_b})
        listed, before = [], 0
        for cut in cuts:
            part_a = [str(i) for i, (s, e) in zip(ids_a, span_a) if before <= s and e <= cut]
            part_b = [str(i) for i, (s, e) in zip(ids_b, span_b) if before <= s and e <= cut]
            listed.append(",".join(part_a) + "|" + ",".join(part_b))
            before = cut
        links = Counter()
        for i, (s, e) in zip(ids_a, span_a):
            for j, (t, f) in zip(ids_b, span_b):
                if s < f and t < e:
                    links[i, j] += 1
        made.append((len(ids_a), len(ids_b), len(cuts), hashlib.sha256(";".join(listed).encode()).hexdigest(), links))
    counts = Counter(pair for *_, links in made for pair in links)
    highest = Counter()
    for (i, _), n in counts.items():
        highest[i] = max(highest[i], n)
    out = []
    for n_a, n_b, groups, digest, links in made:
        best = sum(n for pair, n in links.items() if counts[pair] == highest[pair[0]])
        out.append((n_a, n_b, groups, sum(links.values()), best, sum(n * counts[p] for p, n in links.items()), digest))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("shipped", [1 << 20, 40, 0])
def test_equals_the_slow_reading(spark, docs, shipped):
    texts = [t if t is None or len(t) < 2000 else t[:400] for t in TEXTS]
    found = alignment.align_and_count(docs(list(enumerate(texts))), A, B, shipped).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in found] == slow(texts)


def test_given_texts(spark, small_tables):
    some = small_tables("documents").where("length(text) < 700")
    texts = some.orderBy("doc_id").toPandas()
    found = alignment.align_and_count(some, A, B).orderBy("doc_id").collect()
    assert len(found) == len(texts) > 20
    assert [tuple(r[c] for c in COLUMNS) for r in found] == slow([t for t in texts.text])


def test_rows_without_id_repeats_and_clashing_columns(spark):
    rows = [(None, "a b", 1, "x"), (7, "a b", 2, "y"), (7, "a b", 2, "y"), (7, "c", 3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row long, n_links string")
    found = sorted((r["doc_id"] or 0, r["n_links"], r["count_sum"]) for r in alignment.align_and_count(df, A, B).collect())
    assert len(found) == 4 and found[0] == (0, 2, 6) and found[2:] == [(7, 2, 6), (7, 2, 6)]
    assert alignment.align_and_count(df.limit(0), A, B).count() == 0


def test_fast_path_equals_the_tokenizer():
    tool = alignment.Aligner(A, B)
    assert tool.fast is not None
    draw = random.Random(11)
    signs = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xC0, 0x100)] if c not in (0xD7, 0xF7)]
    words = ["the", " ", "  ", "\n\n", "'s", "'LL", "n't", "<|endoftext|>", "ing", "é", "42"]
    texts = ["".join(draw.choice(signs if draw.random() < 0.4 else words) for _ in range(draw.randrange(1, 80))) for _ in range(3000)]
    assert all(alignment.USUAL.fullmatch(t) for t in texts)
    quick, sizes = tool.ids_a(texts)
    tool.fast = None
    slow_ids, slow_sizes = tool.ids_a(texts)
    assert sizes.tolist() == slow_sizes.tolist() and quick.tolist() == slow_ids.tolist()


def test_very_long_text(spark, docs):
    text = "Schöne wörter und mehr. " * 40_000
    row = alignment.align_and_count(docs([(1, text), (2, "x")]), A, B).where("doc_id = 1").first()
    assert row["n_a"] > 100_000 and row["n_links"] >= max(row["n_a"], row["n_b"])


def test_vocabulary_file_is_the_same_as_the_ranks():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    tool = alignment.Aligner(A, B)
    for entry, number in list(ranks.items())[::97]:
        assert bytes(tool.pool_a.joined(__import__("numpy").array([number]))) == entry
