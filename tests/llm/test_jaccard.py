import random
import re

import numpy as np
import pytest

from eventfares.llm import jaccard
from eventfares.llm.components import components

SCHEMA = "doc_id bigint, text string, n bigint, set_id string, keys string, band int"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
A_TO_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = SPACE.findall((text or "").translate(A_TO_Z))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def expected(rows):
    sets = {}
    for i, text in rows:
        sets.setdefault(i, []).append(shingles(text))
    ids = [i for i in sets if i is not None]
    low = {i: i for i in ids}

    def alike(a, b):
        return any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b])

    links = [(a, b) for a in ids for b in ids if a < b and alike(a, b)]
    for _ in ids:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    return sorted(((i, len(shingles(t)), low.get(i)) for i, t in rows), key=str)


def found(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()], key=str)


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y", 2) for i, t in rows], SCHEMA)


def rows_of(seed, n=120):
    """Documents with edits around the threshold, chains of them, shared lines and short texts."""
    pick = random.Random(seed)
    common = " ".join(f"common{k}" for k in range(12))
    bases = [[f"w{b}x{pick.randrange(400)}" for _ in range(pick.choice([3, 8, 30, 80, 200]))] for b in range(8)]
    rows = []
    for i in range(n):
        words = list(pick.choice(bases))
        for _ in range(pick.randrange(max(1, len(words) // 12) + 1)):
            words[pick.randrange(len(words))] = f"new{pick.randrange(10**6)}"
        if pick.random() < 0.3:
            words[pick.randrange(len(words)) :] += ["tail"]
        if pick.random() < 0.5:
            words = common.split() + words
        rows.append((i, pick.choice([" ", "\n", "\t\x0b "]).join(words)))
    return rows


ODD = [
    (500, None), (501, ""), (502, " \n"), (503, "one"), (504, "ONE"), (505, "a b c d"), (506, "A b  c\td"), (507, "é É"), (508, "É É"),
    (None, "a b c d"), (None, "a b c d"), (509, "a b c d e"), (510, "\xa0  "),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = rows_of(seed) + ODD + [(0, rows_of(seed)[0][1])]
    assert found(jaccard.near_duplicates(table(spark, rows).repartition(5))) == expected(rows)


def test_clusters_split_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_SHINGLES", 200)
    monkeypatch.setattr(jaccard, "TILE_DOCS", 4)
    rows = rows_of(3)
    assert found(jaccard.near_duplicates(table(spark, rows))) == expected(rows)


def test_a_large_group_of_near_copies_and_a_very_long_text(spark):
    pick = random.Random(5)
    base = [f"w{k}" for k in range(100)]
    rows = []
    for i in range(300):
        words = list(base)
        words[pick.randrange(100)] = f"own{i}"
        rows.append((i, " ".join(words)))
    long = " ".join(f"long{k}" for k in range(60_000))
    rows += [(900, long), (901, long + " more")]
    assert found(jaccard.near_duplicates(table(spark, rows))) == expected(rows)


def test_one_of_each_group_stays(spark):
    rows = [(1, "a b c d e f"), (2, "A b c d e f"), (3, "other words in here, all new"), (None, "a b c d e f"), (4, None), (5, None)]
    left = jaccard.keep_one(table(spark, rows))
    assert left.columns == table(spark, rows).columns
    assert sorted([(r.doc_id, r.text) for r in left.collect()], key=str) == sorted([rows[0], *rows[2:]], key=str)


def test_empty(spark):
    assert jaccard.near_duplicates(table(spark, [])).count() == 0


def test_bitmaps_never_underestimate():
    pick = np.random.default_rng(4)
    sets = [np.unique(pick.integers(0, 300, pick.integers(1, 120)).astype(np.uint64) << np.uint64(13)) for _ in range(60)]
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    sets, sizes = [sets[i] for i in order], sizes[order]
    left, right = jaccard._bounded_pairs(sizes, jaccard._bitmaps(sets, sizes), None)
    pairs = set(zip(left.tolist(), right.tolist()))
    for i in range(60):
        for j in range(i + 1, 60):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                assert (i, j) in pairs


def test_components(spark):
    pick = random.Random(6)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(200)] + [(400 + k, 401 + k) for k in range(60)] + [(7, 7), (None, 3)]
    low = {}
    for a, b in links:
        if a is not None and a != b:
            low.setdefault(a, a), low.setdefault(b, b)
    for _ in range(200):
        for a, b in links:
            if a is not None and a != b:
                low[a] = low[b] = min(low[a], low[b])
    got = components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert sorted(map(tuple, got.collect())) == sorted(low.items())
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
