import numpy as np
import pytest

from eventfares.llm import embed

SCHEMA = "vec_id bigint, embedding array<float>, label int, cell int, rep string"


def expected(rows, cosine):
    def unit(v):
        if v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v):
            return None
        v = np.array(v, np.float32).astype(float)
        return v / np.linalg.norm(v) if v.any() else None

    units = [unit(v) if i is not None and label is not None else None for i, v, label in rows]
    n = len(rows)
    linked = [
        [
            a != b and units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2]
            and len(units[a]) == len(units[b]) and units[a] @ units[b] >= cosine
            for b in range(n)
        ]
        for a in range(n)
    ]
    low = [r[0] for r in rows]
    for _ in range(n):
        for a in range(n):
            low[a] = min([low[a], *(low[b] for b in range(n) if linked[a][b])]) if any(linked[a]) else low[a]
    return sorted(((rows[a][0], sum(linked[a]), low[a], rows[a][0] == low[a]) for a in range(n)), key=str)


def rows_of(pick):
    centres = pick.normal(size=(6, 8))
    rows = [(int(i), (centres[i % 6] + pick.normal(size=8) * (0.1 if i % 2 else 0.6)).tolist(), int(i % 3)) for i in range(150)]
    rows += [(200 + i, rows[i][1], rows[i][2]) for i in range(0, 30, 2)]
    rows += [(300 + i, rows[1][1], 1) for i in range(10)] + [(5, rows[5][1], rows[5][2])]
    rows += [(400, None, 1), (401, [], 1), (402, [0.0] * 8, 1), (403, [1.0, None] * 4, 1), (404, [float("nan")] * 8, 1)]
    rows += [(405, [float("inf")] * 8, 1), (406, rows[1][1], None), (407, rows[1][1][:4], 1), (408, [1e30] * 8, 1), (409, [1e-30] * 8, 1)]
    return rows


def found(df):
    return sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()], key=str)


@pytest.mark.parametrize("sizes", [(1000, 1000), (12, 5)])
def test_against_brute_force(spark, sizes):
    rows = rows_of(np.random.default_rng(2))
    vectors = spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA).repartition(3)
    got = embed.near_duplicates(vectors, 0.93, cell_vectors=sizes[0], block_vectors=sizes[1])
    assert found(got) == expected(rows, 0.93)


def test_empty_and_without_an_id(spark):
    assert embed.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = spark.createDataFrame([(None, [1.0], 1, 0, "")] * 2, SCHEMA)
    assert found(embed.near_duplicates(alone)) == [(None, 0, None, True)] * 2
