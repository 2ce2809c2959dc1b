import random
import re
from collections import Counter

import numpy as np
import pytest

from eventfares.llm import collocations as c

from .. import compare

SCHEMA = "doc_id bigint, text string, lang string, f int, ids string, word string, n int"


def expect(rows, min_count, top):
    counts, words = Counter(), Counter()
    for _, text, lang in rows:
        low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            found = [w for w in re.split("[ \t]", piece) if w]
            words[lang or "und"] += len(found)
            for m in range(1, 5):
                for i in range(len(found) - m + 1):
                    counts[lang or "und", tuple(found[i : i + m])] += 1
    kept = []
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= min_count}
    for (lang, phrase), a in candidates.items():
        longer = [f for (g, p), f in candidates.items() if g == lang and len(p) > len(phrase) and any(p[i : i + len(phrase)] == phrase for i in range(len(p)))]
        if any(100 * f >= 80 * a for f in longer):
            continue
        cuts = [(counts[lang, phrase[:k]], counts[lang, phrase[k:]]) for k in range(1, len(phrase))]
        score, _, l, r = min((2_000_000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(cuts))
        kept.append((lang, " ".join(phrase), a, l, r, words[lang], score))
    out = []
    for lang in {k[0] for k in kept}:
        order = sorted((k for k in kept if k[0] == lang), key=lambda k: (-k[6], -k[2], k[1].encode()))
        out += [(k[0], i, *k[1:]) for i, k in enumerate(order[:top], 1)]
    return sorted(out)


def made():
    pick = random.Random(4)
    common = ["the", "of", "The", "é", "and", "x1"]
    bits = [*common, *common, *[f"w{i}" for i in range(12)], ".", ",", "\n", "\t", "  ", "\x1c", "\x0b", "\x85", "中文", "-"]
    rows = [(i, " ".join(pick.choice(bits) for _ in range(pick.randrange(60))), pick.choice(["en", "de", None, "und"])) for i in range(120)]
    rows += [(500 + i, "one two three four five six. same same same same same", "en") for i in range(30)]
    return [*rows, (1, None, "en"), (None, "", None), (2, "...", "fr"), (3, "word", "es"), (4, "a b " * 5000, "de"), (4, "a b " * 5000, "de")]


@pytest.mark.parametrize("budget, block_bytes, min_count, top", [(c.BUDGET, c.BLOCK_BYTES, 3, 50), (40, 3000, 3, 2000), (5, 500, 2, 2000), (400, 10**6, 30, 7)])
def test_against_counting_every_phrase(spark, budget, block_bytes, min_count, top):
    rows = made()
    docs = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA)
    found = c.collocations(docs, min_count=min_count, top=top, budget=budget, block_bytes=block_bytes)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == expect(rows, min_count, top)


def test_no_documents_and_no_words(spark):
    for rows in ([], [(1, None, None), (2, " . ", "en")]):
        assert c.collocations(spark.createDataFrame(rows, "doc_id int, text string, lang string")).count() == 0


def test_groups_keep_to_the_budget(spark):
    """However often a word or a pair comes, its group's suffixes stay within the budget, unless they
    are all equal, and so one number."""
    pick = random.Random(6)
    rows = [(i, " ".join(["hot", pick.choice("abcdefgh"), pick.choice("xyz"), pick.choice("klmnop")]) , "en") for i in range(3000)]
    blocks = c._blocks(spark.createDataFrame(rows, "doc_id int, text string, lang string"), "text", "lang", 5000).cache()
    words = c._number(blocks, 2, 100)
    sequences = c._sequences(blocks, words)
    parted = c._part(sequences, words, 100)
    found = np.concatenate([c._suffixes(c._expand(r.ids, np.uint32)) for r in sequences.collect()])
    high, low, n = c._merge(*c._keys(found), np.ones(len(found), np.int64))
    cuts = c._cuts(high, low, *parted.keys())
    sizes = [n[a:b].sum() for a, b in zip(cuts, cuts[1:]) if b - a != 1]
    assert n.sum() == len(found) == 9000 and max(sizes) <= 100 and len(parted.hot) >= 3
    blocks.unpersist()


def test_scores_beyond_64_bits(spark):
    big = 6 * 10**13
    words = spark.createDataFrame([(i, "en", bytearray(f"w{i}".encode()), big) for i in (1, 2)], "id bigint, lang string, word binary, f bigint")
    nodes = spark.createDataFrame([([1, 2], big - 1)], "ids array<bigint>, f bigint")
    assert c._scored(nodes, words).first().score == 2_000_000 * (big - 1) // (2 * big)


def test_the_query_on_a_whole_table(spark):
    at = "/root/testdata/sf0.01"
    rows, ours, theirs = compare.differences(c.op13(spark, at), compare.connect(at), c.OP13_SQL)
    assert rows > 100 and not ours and not theirs, (ours[:3], theirs[:3])
