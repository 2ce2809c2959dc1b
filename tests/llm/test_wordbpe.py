import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eventfares.llm import wordbpe
from eventfares.llm.lexicon import Lexicon, compile_lexicon

BITS = [
    "a", "b", " ", "é", "é", "\n", "\t", "\x1c", "\x85", "　", "Ⅷ", "१", "x'll", "'S", "!!", "😀", "́", "中",
    "Hello ", "  ", "\xa0", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "\x00", "İ", "ß", "՘", "Ᲊ", "꟎", "12",
]


@pytest.fixture(scope="module")
def source():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def standard(source):
    return Tokenizer.from_str(source)


def texts():
    pick = random.Random(1)
    made = ["".join(pick.choice(BITS) for _ in range(pick.randrange(40))) for _ in range(300)]
    return [*made, "", " ", "word " * 20_000, "q" * 5000, "".join(pick.choice("abcdet") for _ in range(3000)), "The the THE."]


@pytest.mark.parametrize("most", [wordbpe.LEXICON_WORDS, 40, 0])
def test_documents_as_the_standard_library_has_them(spark, source, standard, most):
    rows = [*enumerate(texts()), (7, "a row of the same id"), (None, "no id"), (900, None)]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id bigint, text string, n_tokens int, ids string")
    expected = []
    for i, t in rows:
        ids = standard.encode(t or "", add_special_tokens=False).ids
        decoded = standard.decode(ids, skip_special_tokens=False)
        hashes = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)]
        expected.append(((i, len(ids), *hashes), (i, ids, decoded)))
    found = wordbpe.digests(docs, source, most=most).collect()
    assert sorted(map(tuple, found), key=str) == sorted([e[0] for e in expected], key=str)
    if most == 40:
        whole = wordbpe.encode(docs, source, most=most).collect()
        assert sorted(map(tuple, whole), key=str) == sorted([e[1] for e in expected], key=str)


def test_real_documents_as_the_standard_library_has_them(spark, source, standard):
    small = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for row in wordbpe.op11(spark, small).collect():
        ids = standard.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(standard.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_no_documents_and_a_view_that_is_all_null(spark, source):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert wordbpe.digests(none, source).count() == 0
    null = spark.createDataFrame([(1, None)], "doc_id bigint, text string")
    assert wordbpe.encode(null, source).collect() == [(1, [], "")]


def test_the_lexicon_has_its_words_and_no_others(tmp_path):
    pick = random.Random(3)
    words = {bytes(pick.choice(b"ab\xffc") for _ in range(pick.randrange(1, 9))) for _ in range(400)}
    entries = {w: [pick.randrange(99) for _ in range(pick.randrange(1, 4))] for w in words}
    at = tmp_path / "lexicon"
    at.write_bytes(compile_lexicon(entries))
    lexicon = Lexicon.open(str(at))
    asked = [*words, *[w + b"a" for w in words], *[w[:-1] for w in words], b"", b"z" * 50]
    for word, number in zip(asked, lexicon.find(asked).tolist()):
        assert (number >= 0) == (word in entries)
        if number >= 0:
            assert lexicon.ids_of(number) == entries[word] and sorted(words)[number] == word


def test_the_lexicon_is_minimal():
    words = [a + b for a in (b"x", b"yy", b"z") for b in (b"ing", b"ed", b"s")]
    lexicon = Lexicon(compile_lexicon({w: [1] for w in words}))
    # One state for each different set of endings.
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    endings = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in prefixes}
    assert len(lexicon.finals) == len(endings)


def test_an_empty_lexicon_holds_nothing():
    assert Lexicon(compile_lexicon({})).find([b"a", b""]).tolist() == [-1, -1]


def test_the_most_frequent_words_fit_the_bound(spark):
    rows = [(f"w{i}".encode(), n) for i, n in enumerate([100, 100, 50, 3, 3, 3, 1])]
    counts = spark.createDataFrame(rows, "word binary, n bigint")
    for most, expected in ((0, 0), (1, 0), (2, 2), (4, 3), (6, 6), (9, 7)):
        assert wordbpe.frequent(counts, most).count() == expected
