"""Near-duplicate vectors by spherical k-means cells and blocked cosine products."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfares.llm.components import components
from eventfares.settings import keep

COSINE = 0.93
CELL_VECTORS = 2000
MAX_CELLS = 4096
SAMPLE_PER_CELL = 100
ROUNDS = 10
BLOCK_VECTORS = 1000
SLACK = 1e-6

_TILED = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])


def near_duplicates(
    vectors: DataFrame,
    cosine: float = COSINE,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    cell_vectors: int = CELL_VECTORS,
    block_vectors: int = BLOCK_VECTORS,
) -> DataFrame:
    """One row per vector: `vec_id, n_links, component_id, kept`.

    Vectors of one label and length link when the cosine of their components, as doubles, is at
    least `cosine`. Those that are null, empty, zero or hold a null or non-finite component, those
    without a label and those without an id link with nothing and are kept. `component_id` is the
    smallest id that links lead to. Rows that repeat an id are vectors of their own for `n_links`.
    Other columns are not looked at; an empty table gives no rows.

    Equal vectors are compared once. The rest are dealt to cells (see `_cells`), and each cell is
    compared in blocks, so no task holds more than two blocks whatever the size of a cell. Every
    link is found.
    """
    rows = keep(
        vectors.select(
            F.col(vec_id).cast("bigint").alias("vec_id"),
            F.col(label).cast("string").alias("label"),
            F.col(embedding).cast("array<double>").alias("vec"),
        ).withColumn("usable", _usable()),
        "vectors",
    )
    usable = rows.where("usable")
    classes = keep(
        usable.groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")),
        "vector-classes",
    )
    tiles = _tiles(_cells(classes, cosine, cell_vectors), block_vectors)
    found = keep(_compare(tiles, cosine), "vector-links")

    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    joined = components(found.where("root <> rep").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    joined = joined.select(F.col("id").alias("rep"), "component_id")
    by_class = (
        classes.join(counts, "rep", "left")
        .join(joined, "rep", "left")
        .select(
            F.col("label").alias("c_label"),
            F.col("vec").alias("c_vec"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "rep").alias("component_id"),
        )
    )
    linked = usable.join(by_class, (F.col("label") == F.col("c_label")) & (F.col("vec") == F.col("c_vec"))).select(
        "vec_id", "n_links", "component_id"
    )
    alone = rows.where("not usable").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    kept = F.col("vec_id").eqNullSafe(F.col("component_id"))
    return linked.unionByName(alone).withColumn("kept", kept)


def _usable():
    """Whether a row can link at all."""
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    nonzero = F.exists("vec", lambda x: x != 0)
    named = F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    return F.coalesce(named & sound & nonzero, F.lit(False))


# Cells


def _cells(classes: DataFrame, cosine: float, cell_vectors: int) -> DataFrame:
    """`classes` with a `cell` for every cell they have to be in: `label, vec, rep, copies, cell, home`.

    Groups of one label and length that are larger than `cell_vectors` are split by spherical
    k-means, fitted on about `SAMPLE_PER_CELL` vectors for each cell; there are at most about
    `MAX_CELLS` cells, as what a cell should hold grows with the table beyond that. A vector's home
    is the cell of its nearest centre. It also visits each cell that a vector within the angle may
    have for its home: one whose centre is not so much farther that the plane between the two lies
    beyond that angle. So two vectors that link always meet in the home of either.
    """
    spark = classes.sparkSession
    keyed = classes.withColumn("dim", F.size("vec"))
    sizes = keyed.groupBy("label", "dim").agg(F.count("*").alias("n"))
    per_cell = max(cell_vectors, (sizes.agg(F.sum("n")).first()[0] or 0) // MAX_CELLS)
    large = sizes.where(F.col("n") > per_cell).withColumn("k", F.ceil(F.col("n") / per_cell).cast("int"))
    draw = F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) / float(1 << 30)
    sample = (
        keyed.join(F.broadcast(large), ["label", "dim"])
        .where(draw < F.col("k") * SAMPLE_PER_CELL / F.col("n"))
        .select("label", "dim", "k", "vec", "rep")
    )
    fitted = sample.groupBy("label", "dim").applyInPandas(_fit, "label string, dim int, centres array<double>")
    centres = {(r.label, r.dim): np.array(r.centres).reshape(-1, r.dim) for r in fitted.collect()}
    shared = spark.sparkContext.broadcast(centres)
    reach = float(np.sqrt(1 - cosine**2)) + SLACK if cosine > 0 else 2.0

    def assign(frames):
        for frame in frames:
            for (label, dim), part in frame.groupby(["label", "dim"], sort=False):
                held = shared.value.get((label, dim))
                if held is None:
                    yield part.assign(cell=0, home=True)
                    continue
                unit = _unit(np.stack(part["vec"].to_numpy()))
                near = unit @ held.T
                home = near.argmax(axis=1)
                gaps = np.linalg.norm(held[home][:, None, :] - held[None], axis=2)
                behind = near[np.arange(len(part)), home][:, None] - near
                who, cell = np.nonzero(behind <= reach * gaps + SLACK)
                yield part.iloc[who].assign(cell=cell, home=home[who] == cell)

    schema = "label string, vec array<double>, rep bigint, copies bigint, dim int, cell int, home boolean"
    return keyed.mapInPandas(assign, schema)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _fit(frame: pd.DataFrame) -> pd.DataFrame:
    """Centres of spherical k-means over one sample, started from evenly spaced vectors."""
    frame = frame.sort_values("rep")
    unit = _unit(np.stack(frame["vec"].to_numpy()))
    k = min(int(frame["k"].iloc[0]), len(unit))
    centres = unit[np.linspace(0, len(unit) - 1, k).astype(int)]
    for _ in range(ROUNDS):
        home = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, unit)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centres)
    first = frame.iloc[0]
    return pd.DataFrame({"label": [first["label"]], "dim": [first["dim"]], "centres": [centres.ravel()]})


# Blocks


def _tiles(placed: DataFrame, block_vectors: int) -> DataFrame:
    """Pairs of a block of home vectors and a block of any vectors of the same cell.

    Vectors are dealt to blocks by a hash, with as many blocks as the cell needs.
    """
    cell = ["label", "dim", "cell"]
    sizes = placed.groupBy(*cell).agg(F.count("*").alias("m"))
    sizes = sizes.select(*cell, F.ceil(F.col("m") / block_vectors).cast("int").alias("blocks"))
    dealt = placed.join(sizes, cell).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    packed = dealt.groupBy(*cell, "block", "home").applyInArrow(
        _pack,
        "label string, dim int, cell int, home boolean, reps binary, copies binary, vecs binary",
    )
    packed = keep(packed, "vector-blocks")
    left = packed.where("home").select(*cell, *[F.col(c).alias(f"a_{c}") for c in ("reps", "copies", "vecs")])
    right = packed.select(*cell, *[F.col(c).alias(f"b_{c}") for c in ("reps", "copies", "vecs")])
    return left.join(right, cell).drop("label", "cell")


def _pack(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    first = {c: table.column(c)[0].as_py() for c in ("label", "dim", "cell", "home")}
    vecs = table.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, first["dim"])
    return pa.table(
        {
            **{c: [v] for c, v in first.items()},
            "reps": [table.column("rep").to_numpy().tobytes()],
            "copies": [table.column("copies").to_numpy().tobytes()],
            "vecs": [_unit(vecs).tobytes()],
        },
        schema=pa.schema(
            [
                ("label", pa.string()),
                ("dim", pa.int32()),
                ("cell", pa.int32()),
                ("home", pa.bool_()),
                ("reps", pa.binary()),
                ("copies", pa.binary()),
                ("vecs", pa.binary()),
            ]
        ),
    )


def _compare(tiles: DataFrame, cosine: float) -> DataFrame:
    """For each vector of a tile with links: `rep`, the `n` vectors it links with from its home side,
    and the `root` of its component within the tile."""

    def compare(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                tile = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                a, b = (np.frombuffer(tile[f"{s}_reps"], np.int64) for s in "ab")
                copies = np.frombuffer(tile["b_copies"], np.int64)
                left, right = (np.frombuffer(tile[f"{s}_vecs"]).reshape(-1, tile["dim"]) for s in "ab")
                links = (left @ right.T >= cosine) & (a[:, None] != b[None])
                if links.any():
                    yield from _linked(a, b, copies, links)

    return tiles.mapInArrow(compare, "rep bigint, n bigint, root bigint")


def _linked(a, b, copies, links):
    here, there = links.any(axis=1), links.any(axis=0)
    a, b, copies, links = a[here], b[there], copies[there], links[here][:, there]
    n = links @ copies
    top = np.iinfo(np.int64).max
    root_a = a.copy()
    while True:
        root_b = np.minimum(b, np.where(links, root_a[:, None], top).min(axis=0))
        new = np.minimum(root_a, np.where(links, root_b[None], top).min(axis=1))
        if (new == root_a).all():
            break
        root_a = new
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(n), pa.array(root_a)], schema=_TILED)
    yield pa.RecordBatch.from_arrays([pa.array(b), pa.array(np.zeros(len(b), np.int64)), pa.array(root_b)], schema=_TILED)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP5_SQL = """
WITH v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), u AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), n AS (
  SELECT a, count(*) AS n_links FROM l GROUP BY a
), r AS (
  WITH RECURSIVE reach(a, b) AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a)
  SELECT a, min(b) AS low FROM reach GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN r ON r.a = vec_id
"""
