import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from eventfares.llm import bpe, tokens

PATTERN = public_tokenizers.PATTERN
BITS = ["a", "b", " ", "é", "\n", "\t", "\x1c", "\x85", "　", "Ⅷ", "१", "x'll", "'s", "!!", "😀", "́", "中", "hello ", "  ", "\xa0"]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def standard(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    pick = random.Random(1)
    made = ["".join(pick.choice(BITS) for _ in range(pick.randrange(40))) for _ in range(200)]
    return [*made, "", "<|endoftext|>", "word " * 20_000, "q" * 5000]


def test_documents_as_the_standard_library_has_them(spark, ranks, standard):
    rows = [*enumerate(texts()), (7, "a row of the same id"), (None, "no id"), (900, None)]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id bigint, text string, n_tokens int, ids string")
    expected = []
    for i, t in rows:
        ids = standard.encode_ordinary(t or "")
        packed = np.array(ids, "<u4").tobytes()
        expected.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), ids))
    found = bpe.digests(docs, ranks, PATTERN, ids=True).collect()
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    whole = bpe.encode(docs, ranks, PATTERN).collect()
    assert sorted((bytes(r.decoded) for r in whole)) == sorted((t or "").encode() for _, t in rows)


def test_long_words_merge_alike_either_way(ranks, standard):
    encoder = bpe.Encoder(ranks, PATTERN)
    pick = random.Random(2)
    for n in (2, 50, 101, 3000):
        word = "".join(pick.choice("abcdet") for _ in range(n)).encode()
        assert encoder._merge_long(word) == encoder.merge(word) == standard.encode_ordinary(word.decode())


def test_held_words_are_bounded(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "HELD_WORDS", 3)
    encoder = bpe.Encoder(ranks, PATTERN)
    text = " ".join("abcdefgh") * 3
    assert encoder.encode(text) == bpe.Encoder(ranks, PATTERN).encode(text) and len(encoder.held) <= 3


def test_the_native_fold_over_distinct_words(spark, ranks, standard):
    docs = spark.createDataFrame([(t,) for t in texts()[:60]] + [("Thst anblewh inthst",)], "text string")
    words = docs.selectExpr("text").select(bpe.split_words(docs.text, PATTERN).alias("words"))
    distinct = words.selectExpr("explode(words) word").distinct().limit(80).union(spark.createDataFrame([(None,), ("",)], "word string"))
    found = bpe.encode_words(distinct, bpe.rank_table(ranks, spark)).collect()
    for row in found:
        assert row.ids == (standard._core_bpe.encode_single_piece(row.word.encode()) if row.word else [])


def test_the_native_fold_keeps_columns_of_any_name(spark, ranks, standard):
    names = ["row", "hex", "_hex", "piece", "pair"]
    words = spark.createDataFrame([("hello", *names, "old")], ["word", *names, "ids"])
    row = bpe.encode_words(words, bpe.rank_table(ranks, spark)).first()
    assert [row[n] for n in names] == names and row.ids == standard.encode_ordinary("hello")


def test_no_documents(spark, ranks):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.digests(none, ranks, PATTERN).count() == 0
    assert tokens.count_tokens(none, ranks, PATTERN).count() == 0


def test_sections_add_up_and_follow_the_rule(spark, ranks, standard):
    rows = [(1, "one line\n\n\ntwo é中 lines"), (1, "one line"), (2, None), (3, ""), (None, "x\n"), (4, "😀\n" * 50)]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id bigint, text string, section string")
    found = tokens.count_tokens(docs, ranks, PATTERN).collect()
    by_doc = sorted((r.doc_id is None, r.doc_id, r.section, r.n_chars, r.n_tokens, r.n_crossing) for r in found)
    expected = []
    for i, t in rows:
        t = t or ""
        ids = standard.encode_ordinary(t)
        sections = t.split("\n")
        spans, at = [], 0
        for k, s in enumerate(sections):
            spans.append((at, at + len(s) + (k < len(sections) - 1)))
            at = spans[-1][1]
        counts, crossing = [0] * len(spans), [0] * len(spans)
        data, at = t.encode(), 0
        for token in ids:
            end = at + len(standard.decode_single_token_bytes(token))
            number = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) - 1
            low, high = number[at], number[end - 1] + 1
            overlap = [min(high, b) - max(low, a) for a, b in spans]
            to = max(range(len(spans)), key=lambda k: (overlap[k], -k))
            counts[to] += 1
            crossing[to] += not (spans[to][0] <= low and high <= spans[to][1])
            at = end
        expected += [(i is None, i, k, b - a, counts[k], crossing[k]) for k, (a, b) in enumerate(spans)]
    assert by_doc == sorted(expected)
    assert any(r[5] for r in by_doc)


def test_tokens_outside_all_sections():
    spans = np.array([0, 3, 6, 20]), np.array([3, 6, 9, 22])
    place, crossing = tokens.allocate(spans, (np.array([2, 7]), np.array([5, 9])))
    assert place.tolist() == [0, 0, 1, -1] and crossing.tolist() == [True, True, True, False]
    place, _ = tokens.allocate(spans, (np.zeros(0, int), np.zeros(0, int)))
    assert place.tolist() == [-1] * 4
