"""Near-duplicate documents: an exact join of shingle sets by Jaccard similarity.

1. Every document becomes the set of its shingles' hashes. Blocks of documents send their shingles
   to the part of the hash space they fall in, which answers how common each one is.
2. Of two sets as similar as asked, each holds three quarters of the other. So a document with more
   than a quarter of its shingles to itself links with nothing, and of any other the rarest quarter
   (and one more) has a shingle in common with every document it links with. Documents of
   compatible size bands that share such a shingle form clusters; every link is within a cluster.
3. Clusters are compared in tiles of size bands. Hashed bitmaps bound each overlap from above, and
   what they leave is intersected exactly. Only links that connect something new leave a tile.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfares.llm.common import batch_of, map_arrow, text_bytes
from eventfares.llm.components import components
from eventfares.settings import keep

WORDS = 5
# Similarity of three quarters, as the parts of a whole.
SHARED, WHOLE = 75, 100
PART_SHINGLES = 1_000_000
BLOCK_BYTES = 4 << 20
TILE_SHINGLES = 300_000
TILE_DOCS = 1000
PAIRS_AT_ONCE = 50_000
MAX_BITS = 1 << 16

ENTRIES, TABLE = 0, 1

_MIX = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)
_32 = np.uint64(32)

_SENT = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int64()),
        ("kind", pa.int32()),
        ("a", pa.binary()),
        ("b", pa.binary()),
        ("c", pa.binary()),
    ]
)
_SETS = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()), ("keys", pa.list_(pa.int64()))]
)
_HASHED = pa.schema([("rep", pa.int64()), ("cluster", pa.int64()), ("bin", pa.int64()), ("band", pa.int32()), ("salt", pa.int32()), ("hashes", pa.binary())])
_PACKED = pa.schema([("cluster", pa.int64()), ("band", pa.int32()), ("salt", pa.int32()), ("reps", pa.binary()), ("sizes", pa.binary()), ("hashes", pa.binary())])
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: `doc_id, n_shingles, component_id`.

    Words are runs of bytes other than space and 0x09-0x0D of the text with A-Z lower-cased; a set
    is the distinct runs of `WORDS` words, or all the words if they are fewer. Documents link when
    their sets' Jaccard similarity is at least 0.75; `component_id` is the smallest id that links
    lead to, the document's own included. A null text, or one without words, has no shingles and
    links with nothing. A document without an id is counted but links with nothing and has a null
    `component_id`. Rows that repeat an id count as one document with all their links. Other columns
    are not looked at; an empty table gives no rows. Every link is found.
    """
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sets = keep(_sets(docs), "shingle-sets")
    held = sets.where("set_id is not null")
    classes = held.groupBy("set_id").agg(F.min("doc_id").alias("rep"))
    classes = keep(classes, "set-classes")
    keyed = held.where("size(keys) > 0")
    reps = keyed.join(
        classes.select("set_id", F.col("rep").alias("doc_id")), ["set_id", "doc_id"], "left_semi"
    ).select(F.col("doc_id").alias("rep"), "set_id", F.col("n_shingles").alias("n"), "keys")
    reps = keep(reps.withColumn("band", _band(F.col("n"))), "set-keys")

    clusters = components(_cluster_links(reps)).select(F.col("id").alias("rep"), F.col("component_id").alias("cluster"))
    links = keep(_tile_links(docs, reps.drop("keys"), clusters), "near-links")
    joined = components(links).select(F.col("id").alias("rep"), "component_id")
    placed = classes.join(joined, "rep", "left").select("set_id", F.coalesce("component_id", "rep").alias("component_id"))
    found = sets.select("doc_id", "n_shingles", "set_id").join(placed, "set_id", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """`docs` without the documents that a document of smaller id leads to."""
    found = near_duplicates(docs)
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def shingles(text: bytes) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(WORDS, len(words))
    found = np.full(len(words) - k + 1, k, np.uint64)
    for j in range(k):
        found = (found ^ hashes[j : len(words) - k + 1 + j]) * _MIX
        found ^= found >> _32
    return np.unique(found)


def _set_id(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _band(size):
    """Sizes of which neither is under three quarters of the other are in one band or in neighbours."""
    return F.floor(F.log(size) / F.log(F.lit(WHOLE / SHARED))).cast("int")


# Sets, and the shingles that may link them


def _sets(docs: DataFrame) -> DataFrame:
    """`doc_id, n_shingles, set_id, keys`: the keys are of the rarest quarter of shingles, those
    that no other document has left out; there are none if nothing can link."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = int(size // 6 // PART_SHINGLES) + docs.sparkSession.sparkContext.defaultParallelism
    sent = map_arrow(docs, lambda batches: _send(batches, parts), _SENT)
    answered = sent.groupBy("part").applyInArrow(_answer, ", ".join(("part int", "block bigint", "kind int", "a binary", "b binary", "c binary")))
    return answered.groupBy("block").applyInArrow(_choose, "doc_id bigint, n_shingles bigint, set_id binary, keys array<bigint>")


def _send(batches, parts: int):
    # The same split of the input gives the same blocks again, should a task be repeated.
    block = TaskContext.get().partitionId() << 32
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if size >= BLOCK_BYTES:
                yield from _send_block(block, ids, texts, parts)
                block, ids, texts, size = block + 1, [], [], 0
    if ids:
        yield from _send_block(block, ids, texts, parts)


def _send_block(block: int, ids: list, texts: list, parts: int):
    sets = [shingles(t) for t in texts]
    sizes = np.array([len(s) for s in sets])
    names = [_set_id(s) if len(s) and i is not None else None for i, s in zip(ids, sets, strict=True)]
    linkable = np.array([n is not None for n in names])
    who = np.repeat(np.arange(len(ids))[linkable], sizes[linkable])
    hashes = np.concatenate([np.zeros(0, np.uint64), *(s for s, x in zip(sets, linkable, strict=True) if x)])
    keys = ((hashes >> _32) % np.uint64(parts) << _32) | (hashes & _LOW)
    order = np.argsort(keys)
    keys, who = keys[order], who[order]
    starts = np.nonzero(np.append(True, keys[1:] != keys[:-1]))[0] if len(keys) else np.zeros(0, int)
    counts = np.diff(np.append(starts, len(keys)))
    # A shingle of several documents is sent once, under the number of a list that stays here.
    several = counts > 1
    lists = np.cumsum(several) - 1
    sender = np.where(several, len(ids) + lists, who[starts] if len(starts) else 0).astype("<u4")
    members = who[np.repeat(several, counts)].astype(np.int32)
    table = (ids, names, sizes, np.append(0, np.cumsum(counts[several])), members)

    yield batch_of(_SENT, [block % parts], [block], [TABLE], [pickle.dumps(table)], [b""], [b""])
    keys, counts = keys[starts], np.minimum(counts, 255).astype(np.uint8)
    # Within a part by sender, so that senders take next to no room (see `_pack_sorted`).
    order = np.lexsort((sender, keys >> _32))
    keys, sender, counts = keys[order], sender[order], counts[order]
    at = np.searchsorted(keys >> _32, np.arange(parts + 1))
    low = keys.astype("<u4")
    used = np.nonzero(np.diff(at))[0]
    for start in range(0, len(used), 1000):
        some = used[start : start + 1000]
        cut = [(slice(at[p], at[p + 1])) for p in some]
        yield batch_of(
            _SENT,
            some.astype(np.int32),
            [block] * len(some),
            [ENTRIES] * len(some),
            [low[s].tobytes() for s in cut],
            [_pack_sorted(sender[s]) for s in cut],
            [counts[s].tobytes() for s in cut],
        )


def _pack_sorted(values: np.ndarray) -> bytes:
    """Steps between sorted numbers, all low bytes first, which leaves little to a compressor."""
    steps = np.diff(values.astype(np.int64), prepend=0).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack_sorted(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view("<u4").ravel(), dtype=np.int64)


def _answer(table: pa.Table) -> pa.Table:
    """For each block, those of its shingles that are met more than once, and how common they are."""
    rows = table.to_pydict()
    entries = [r for r, kind in enumerate(rows["kind"]) if kind == ENTRIES]
    out = [r for r, kind in enumerate(rows["kind"]) if kind == TABLE]
    result = {c: [rows[c][r] for r in out] for c in _SENT.names}
    if entries:
        keys = [np.frombuffer(rows["a"][r], "<u4") for r in entries]
        all_keys = np.concatenate(keys).astype(np.uint64)
        counts = np.concatenate([np.frombuffer(rows["c"][r], np.uint8) for r in entries]).astype(np.int64)
        ordered = np.sort((all_keys << _32) | np.arange(len(all_keys), dtype=np.uint64))
        place, key = (ordered & _LOW).astype(np.int64), ordered >> _32
        starts = np.nonzero(np.append(True, key[1:] != key[:-1]))[0]
        met = np.add.reduceat(counts[place], starts)
        # In steps of a sixteenth of a doubling; 0 for a shingle met once.
        code = np.minimum(255, 16 * np.log2(met)).astype(np.uint8)
        codes = np.empty(len(all_keys), np.uint8)
        codes[place] = np.repeat(code, np.diff(np.append(starts, len(key))))
        at = 0
        for r, own in zip(entries, keys, strict=True):
            mine = codes[at : at + len(own)]
            at += len(own)
            shared = mine > 0
            if shared.any():
                sender = _pack_sorted(_unpack_sorted(rows["b"][r])[shared])
                values = (rows["part"][r], rows["block"][r], ENTRIES, own[shared].tobytes(), sender, mine[shared].tobytes())
                for c, v in zip(_SENT.names, values, strict=True):
                    result[c].append(v)
    return pa.table(result, schema=_SENT)


def _choose(table: pa.Table) -> pa.Table:
    rows = table.to_pydict()
    kinds = np.array(rows["kind"])
    ids, names, sizes, offsets, members = pickle.loads(rows["a"][int(np.nonzero(kinds == TABLE)[0][0])])
    entries = np.nonzero(kinds == ENTRIES)[0]
    empty = np.zeros(0, np.int64)
    low = np.concatenate([empty, *(np.frombuffer(rows["a"][r], "<u4").astype(np.int64) for r in entries)])
    part = np.concatenate([empty, *(np.full(len(rows["c"][r]), rows["part"][r]) for r in entries)])
    sender = np.concatenate([empty, *(_unpack_sorted(rows["b"][r]) for r in entries)])
    code = np.concatenate([empty, *(np.frombuffer(rows["c"][r], np.uint8).astype(np.int64) for r in entries)])
    key = (part << 32) | low

    # Lists are put in place of their numbers.
    listed = sender >= len(ids)
    which = sender[listed] - len(ids)
    long = np.diff(offsets)[which]
    first = np.repeat(offsets[:-1][which] - np.append(0, np.cumsum(long)[:-1]), long) if len(which) else empty
    doc = np.concatenate([sender[~listed], members[(np.arange(long.sum()) + first).astype(int)]])
    key = np.concatenate([key[~listed], np.repeat(key[listed], long)])
    code = np.concatenate([code[~listed], np.repeat(code[listed], long)])

    shared = np.bincount(doc, minlength=len(ids))
    needed = -(-sizes * SHARED // WHOLE)
    # The rarest come first, so those nobody shares have taken up part of the quarter.
    budget = np.where((shared >= needed) & (sizes > 0), shared - needed + 1, 0)
    able = budget[doc] > 0
    doc, key, code = doc[able], key[able], code[able]
    order = np.lexsort((key, code, doc))
    doc, key = doc[order], key[order]
    rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
    chosen = rank < budget[doc]
    doc, key = doc[chosen], key[chosen]
    bounds = np.searchsorted(doc, np.arange(len(ids) + 1))
    keys = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(key))
    return pa.Table.from_batches([batch_of(_SETS, ids, sizes, names, keys)])


# Clusters


def _cluster_links(reps: DataFrame) -> DataFrame:
    """Links of documents that share a key in compatible bands: each to the smallest that does."""
    held = reps.select("rep", F.explode("keys").alias("key"), "band")
    held = held.select("rep", "key", F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    low = held.groupBy("key", "band").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low <> high")
    return held.join(low, ["key", "band"]).where("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b")).distinct()


# Tiles


def _tile_links(docs: DataFrame, reps: DataFrame, clusters: DataFrame) -> DataFrame:
    placed = keep(reps.join(clusters, "rep"), "clustered")
    total = placed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bins = int(total // TILE_SHINGLES) + 1
    blocks = F.greatest(F.ceil(F.sum("n") / TILE_SHINGLES), F.ceil(F.count("*") / TILE_DOCS))
    whole = placed.groupBy("cluster").agg(blocks.alias("cluster_blocks"))
    banded = placed.groupBy("cluster", "band").agg(blocks.alias("blocks"))
    placed = placed.join(banded, ["cluster", "band"]).join(whole, "cluster")
    # Clusters that fit one tile are put together in bins; others are split by band, and then by hash.
    small = F.col("cluster_blocks") == 1
    placed = placed.select(
        F.col("rep").alias("doc_id"),
        "set_id",
        "cluster",
        F.when(small, F.pmod(F.xxhash64("cluster"), F.lit(bins))).alias("bin"),
        "band",
        F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("salt"),
    )
    columns = ["doc_id", "text", "set_id", "cluster", "bin", "band", "salt"]
    # Hashed, not sorted: the texts are the large side, and ids on the other are unique.
    texts = docs.join(placed.hint("shuffle_hash"), "doc_id").select(*columns)
    hashed = keep(map_arrow(texts, _hash, _HASHED), "tile-sets")

    binned = hashed.where("bin is not null").groupBy("bin").applyInArrow(_compare_bin, "a bigint, b bigint")
    packed = hashed.where("bin is null").groupBy("cluster", "band", "salt").applyInArrow(
        _pack, "cluster bigint, band int, salt int, reps binary, sizes binary, hashes binary"
    )
    packed = keep(packed, "tile-blocks")
    below = packed.select("cluster", F.explode(F.array("band", F.col("band") + 1)).alias("meets"), *[F.col(c).alias(f"b_{c}") for c in ("band", "salt", "reps", "sizes", "hashes")])
    above = packed.select("cluster", F.col("band").alias("meets"), *[F.col(c).alias(f"a_{c}") for c in ("salt", "reps", "sizes", "hashes")])
    once = (F.col("b_band") < F.col("meets")) | (F.col("b_salt") <= F.col("a_salt"))
    tiles = above.join(below, ["cluster", "meets"]).where(once).drop("cluster")
    return binned.unionAll(map_arrow(tiles, _compare_tiles, _LINKS))


def _hash(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            some = batch.slice(start, 500)
            column = dict(zip(some.schema.names, some.columns, strict=True))
            sets = [shingles(t) for t in text_bytes(column["text"])]
            # Another text under the same id is another document's.
            same = [i for i, name in enumerate(column["set_id"].to_pylist()) if len(sets[i]) and _set_id(sets[i]) == name]
            rest = [column[c].take(pa.array(same, pa.int64())) for c in ("doc_id", "cluster", "bin", "band", "salt")]
            yield batch_of(_HASHED, *rest, [sets[i].tobytes() for i in same])


def _compare_bin(table: pa.Table) -> pa.Table:
    found = []
    cluster = table.column("cluster").to_numpy()
    reps = table.column("rep").to_numpy()
    hashes = table.column("hashes")
    order = np.argsort(cluster, kind="stable")
    for members in np.split(order, np.nonzero(np.diff(cluster[order]))[0] + 1):
        sets = [np.frombuffer(hashes[int(m)].as_py(), np.uint64) for m in members]
        found += forest(reps[members], sets)
    return pa.Table.from_batches([_as_links(found)])


def _as_links(found) -> pa.RecordBatch:
    return batch_of(_LINKS, [a for a, _ in found], [b for _, b in found])


def _pack(table: pa.Table) -> pa.Table:
    hashes = table.column("hashes").to_pylist()
    first = [table.column(c)[0].as_py() for c in ("cluster", "band", "salt")]
    sizes = np.array([len(h) // 8 for h in hashes], np.int64)
    reps = table.column("rep").to_numpy()
    return pa.Table.from_batches([batch_of(_PACKED, *[[v] for v in first], [reps.tobytes()], [sizes.tobytes()], [b"".join(hashes)])])


def _compare_tiles(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            tile = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
            reps, sets, side = [], [], []
            alike = tile["a_reps"] == tile["b_reps"]
            for s in "a" if alike else "ab":
                own = np.frombuffer(tile[f"{s}_reps"], np.int64)
                ends = np.cumsum(np.frombuffer(tile[f"{s}_sizes"], np.int64))
                reps.append(own)
                sets += np.split(np.frombuffer(tile[f"{s}_hashes"], np.uint64), ends[:-1])
                side.append(np.full(len(own), len(side)))
            found = forest(np.concatenate(reps), sets, None if alike else np.concatenate(side))
            if found:
                yield _as_links(found)


def forest(reps: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect all that links connect: among all `sets`, or between the two sides.

    Sets are sorted arrays. Pairs are tried from the most alike, as the bitmaps have it, and those
    already connected are left out.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    reps, sets = reps[order], [sets[i] for i in order]
    side = None if side is None else side[order]
    sizes = np.array([len(s) for s in sets], np.int64)
    left, right = _bounded_pairs(sizes, _bitmaps(sets, sizes), side)
    root = list(range(len(sets)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    found = []
    for start in range(0, len(left), PAIRS_AT_ONCE):
        some = slice(start, start + PAIRS_AT_ONCE)
        tops = np.array([top(i) for i in range(len(sets))])
        apart = tops[left[some]] != tops[right[some]]
        for i, j in zip(left[some][apart].tolist(), right[some][apart].tolist(), strict=True):
            a, b = top(i), top(j)
            if a == b:
                continue
            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if WHOLE * shared >= SHARED * (len(sets[i]) + len(sets[j]) - shared):
                root[max(a, b)] = min(a, b)
                if reps[i] != reps[j]:
                    found.append((int(reps[i]), int(reps[j])))
    return found


def _bitmaps(sets: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    bits = min(MAX_BITS, max(256, 1 << int(4 * sizes.max() - 1).bit_length()))
    maps = np.zeros((len(sets), bits // 8), np.uint8)
    for row, found in zip(maps, sets, strict=True):
        held = np.zeros(bits, np.uint8)
        held[(found >> np.uint64(13)) & np.uint64(bits - 1)] = 1
        row[:] = np.packbits(held)
    return maps.view(np.uint64)


def _bounded_pairs(sizes: np.ndarray, maps: np.ndarray, side) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in size order that may be alike enough, the most alike first.

    A bit that one map has and the other lacks is a shingle, at least, that they do not share.
    """
    held = np.bitwise_count(maps).sum(axis=1).astype(np.int64)
    stops = np.searchsorted(sizes * SHARED, sizes * WHOLE, "right")
    left, right, score = [], [], []
    for i in range(len(sizes)):
        j = np.arange(i + 1, stops[i])
        if side is not None:
            j = j[side[j] != side[i]]
        if not len(j):
            continue
        both = np.bitwise_count(maps[j] & maps[i]).sum(axis=1).astype(np.int64)
        most = np.minimum(sizes[i] - (held[i] - both), sizes[j] - (held[j] - both))
        union = sizes[i] + sizes[j] - most
        near = WHOLE * most >= SHARED * union
        left.append(np.full(near.sum(), i, np.int32))
        right.append(j[near].astype(np.int32))
        score.append((most[near] / union[near]).astype(np.float32))
    empty = np.zeros(0, np.int32)
    order = np.argsort(-np.concatenate([empty.astype(np.float32), *score]), kind="stable")
    return np.concatenate([empty, *left])[order], np.concatenate([empty, *right])[order]


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP7_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, list_aggregate(list_slice(w, i, i + 4), 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * o >= 75 * (na.n + nb.n - o)
), r AS (
  WITH RECURSIVE reach(a, b) AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a)
  SELECT a, min(b) AS low FROM reach GROUP BY a
)
SELECT documents.doc_id, coalesce(n.n, 0) AS n_shingles, least(documents.doc_id, coalesce(low, documents.doc_id)) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.a = documents.doc_id
"""
