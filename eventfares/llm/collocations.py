"""Phrases whose words belong together, counted by vertical partitioning of the suffixes of all pieces.

The places of all words are the suffixes of their pieces, cut to the longest phrase. Prefixes of
suffixes are put into groups that fit a memory budget: a word whose suffixes exceed it is extended by
the words that follow it, and so on. Each group's task sorts the suffixes it gets, which is the
subtree below the group's prefixes, and the count of a phrase is the number of leaves below its node.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventfares.llm.common import batch_of, batches_of, map_arrow
from eventfares.settings import keep

# The contract's limits.
MIN_COUNT = 30
MAX_WORDS = 4
CONTAINED = 80  # of 100 places of a phrase
SCALE = 2_000_000
TOP = 2000
NO_LANG = "und"

BUDGET = 1_000_000  # suffixes of a group
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 1 << 20
SALTS = 16

_BREAK = b"\xff"  # in no text of UTF-8
_PLAIN = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", _BREAK * 10 + b" ")
_LOW = np.uint64((1 << 32) - 1)
_32 = np.uint64(32)

_BLOCKS = pa.schema(
    [("block", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("words", pa.binary()), ("counts", pa.binary()), ("places", pa.binary())]
)
_WORDS = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("place", pa.int32()), ("word", pa.binary()), ("n", pa.int64())])
_NUMBERED = pa.schema(
    [("part", pa.int64()), ("seq", pa.int64()), ("lang", pa.string()), ("word", pa.binary()), ("f", pa.int64()), ("starts", pa.bool_()), ("hot", pa.bool_())]
)
_EXTENDED = pa.schema([("parent", pa.int64()), ("word_id", pa.int64()), ("n", pa.int64())])
_MARKED = pa.schema([("parent", pa.int64()), ("word_id", pa.int64()), ("starts", pa.bool_()), ("hot", pa.bool_())])
_SUFFIXES = pa.schema([("grp", pa.int64()), ("keys", pa.binary())])
_NODES = pa.schema([("ids", pa.list_(pa.int64())), ("f", pa.int64())])


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    top: int = TOP,
    budget: int = BUDGET,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The `top` phrases of each language: `lang, rank, phrase, a, l, r, n, score`.

    Texts are lower-cased (A-Z), cut into pieces at `.,;:!?` and line ends, and those into words at
    blanks and tabs. Phrases of 2 to `MAX_WORDS` words that occur `min_count` times or more in a
    language, `a`, are scored by their worst cut into two parts that occur `l` and `r` times; `n` is
    the number of all words. A phrase within a longer one that has `CONTAINED` of 100 of its places
    is dropped. Ranks are by score, `a` and the phrase's bytes. A null text is empty, a null language
    `und`, together with texts that say so. Repeated rows count each. Other columns are not looked
    at, and no documents give no rows. `budget` and `block_bytes` bound memory and change no result.
    """
    blocks = keep(_blocks(docs, text, lang, block_bytes), "blocks")
    words = _number(blocks, min_count, budget)
    sequences = keep(_sequences(blocks, words), "sequences")
    parted = _part(sequences, words, budget)
    nodes = keep(_count(sequences, parted, min_count), "phrases")
    totals = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    return _rank(_scored(nodes, words), words, totals, top)


# Words


def _blocks(docs: DataFrame, text: str, lang: str, block_bytes: int) -> DataFrame:
    """Blocks of a task's texts of one language: their words, how often each occurs, and for every
    place the number of its word within the block, 0 where a piece ends."""

    def read(batches):
        part, seq, held = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            for i in range(batch.num_rows):
                language, value = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                for data in _slices(value.encode().lower().translate(_PLAIN)):
                    block = held.setdefault(language, _Block())
                    block.add(data)
                    if sum(b.size for b in held.values()) >= block_bytes:
                        for key, full in held.items():
                            yield full.weight(), (part << 33 | seq, key, *full.columns())
                            seq += 1
                        held = {}
        for key, full in held.items():
            yield full.weight(), (part << 33 | seq, key, *full.columns())
            seq += 1

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)), F.coalesce(F.col(text).cast("string"), F.lit("")))
    return map_arrow(rows, lambda batches: batches_of(_BLOCKS, read(batches)), _BLOCKS)


def _slices(data: bytes):
    """Parts of a long text, each of whole pieces."""
    at = 0
    while True:
        end = data.find(_BREAK, at + SLICE_BYTES)
        if end < 0:
            yield data[at:]
            return
        yield data[at:end]
        at = end


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Block:
    def __init__(self):
        self.numbers = _Numbers({_BREAK: 0})
        self.places: list[np.ndarray] = []
        self.size = 0

    def add(self, data: bytes) -> None:
        found = data.replace(_BREAK, b" \xff ").split()
        found.append(_BREAK)
        self.places.append(np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found)))
        self.size += len(data) + 1

    def weight(self) -> int:
        return 4 * self.size

    def columns(self):
        places = np.concatenate(self.places)
        counts = np.bincount(places, minlength=len(self.numbers))[1:]
        words = b" ".join([*self.numbers][1:])
        return int(counts.sum()), words, counts.astype(np.int64).tobytes(), _squeeze(places)


def _squeeze(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(array.tobytes())


def _expand(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _block_words(blocks: DataFrame) -> DataFrame:
    """Each block's words: `block, lang, place, word, n`."""

    def explode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = row["words"].split(), np.frombuffer(row["counts"], np.int64)
                for at in range(0, len(words), 50_000):
                    part = words[at : at + 50_000]
                    same = pa.repeat(row["block"], len(part)), pa.repeat(pa.scalar(row["lang"], pa.string()), len(part))
                    places = np.arange(at + 1, at + 1 + len(part), dtype=np.int32)
                    yield batch_of(_WORDS, *same, places, part, counts[at : at + len(part)])

    return map_arrow(blocks.select("block", "lang", "words", "counts"), explode, _WORDS)


def _number(blocks: DataFrame, min_count: int, budget: int) -> DataFrame:
    """The words that are frequent enough for a phrase, numbered from 1 in order of language and
    word: `id, lang, word, f, starts, hot`; see `_mark`."""
    counts = _block_words(blocks).groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)

    def number(batches):
        part = TaskContext.get().partitionId()
        seq, mark = 0, _Marker(budget)
        for batch in batches:
            f = batch.column(2).to_pylist()
            marks = [mark(x) for x in f]
            yield batch_of(
                _NUMBERED, [part] * len(f), range(seq, seq + len(f)), batch.column(0), batch.column(1), f, [m[0] for m in marks], [m[1] for m in marks]
            )
            seq += len(f)

    ranged = counts.select("lang", "word", "f").repartitionByRange("lang", "word").sortWithinPartitions("lang", "word")
    words = keep(map_arrow(ranged, number, _NUMBERED), "words")
    # A row for each partition.
    sizes = sorted(map(tuple, words.groupBy("part").agg(F.count("*")).collect()))
    before = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    offsets = words.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "part bigint, before bigint")
    numbered = words.join(F.broadcast(offsets), "part")
    return numbered.select((F.col("before") + F.col("seq") + 1).alias("id"), "lang", "word", "f", "starts", "hot")


class _Marker:
    """Marks, in order, the prefixes that a group starts with, and those over the budget, which are
    to be extended. Groups hold neighbours that fit the budget together; a hot prefix is alone."""

    def __init__(self, budget: int):
        self.budget, self.held = budget, budget + 1

    def __call__(self, f: int) -> tuple[bool, bool]:
        starts = self.held + f > self.budget
        self.held = f if starts else self.held + f
        return starts, f > self.budget


def _sequences(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """Each block's places with the numbers of frequent words; runs without two neighbours go."""
    known = _block_words(blocks).select("block", "lang", "place", "word").join(words.select("lang", "word", "id"), ["lang", "word"])

    def renumber(known: pa.Table, block: pa.Table) -> pa.Table:
        out = []
        for row in block.to_pylist():
            places = _expand(row["places"], np.int32)
            ids = np.zeros(int(places.max()) + 1, np.int64)
            ids[known.column("place").to_numpy()] = known.column("id").to_numpy()
            found = ids[places]
            there = np.concatenate([[False], found > 0, [False]])
            joined = there[1:-1] & (there[:-2] | there[2:])
            # Of a run of breaks, the last one stays.
            stays = joined | np.concatenate([joined[1:], [False]])
            out.append({"block": row["block"], "ids": _squeeze(np.where(joined, found, 0)[stays].astype(np.uint32))})
        return pa.Table.from_pylist(out, schema=pa.schema([("block", pa.int64()), ("ids", pa.binary())]))

    places = blocks.select("block", "places")
    together = known.select("block", "place", "id").groupBy("block").cogroup(places.groupBy("block"))
    return together.applyInArrow(renumber, "block bigint, ids binary")


# Suffixes


def _suffixes(ids: np.ndarray) -> np.ndarray:
    """The suffixes of two words or more, one row of `MAX_WORDS` numbers each, 0 beyond a run's end."""
    n = len(ids)
    padded = np.concatenate([ids, np.zeros(MAX_WORDS, ids.dtype)])
    columns = [padded[:n]]
    for k in range(1, MAX_WORDS):
        columns.append(np.where(columns[-1] > 0, padded[k : n + k], 0))
    return np.stack(columns, axis=1)[columns[1] > 0]


def _keys(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = rows.astype(np.uint64)
    return wide[:, 0] << _32 | wide[:, 1], wide[:, 2] << _32 | wide[:, 3]


def _merge(high: np.ndarray, low: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted keys without repeats, and the sums of their counts."""
    order = np.lexsort((low, high))
    high, low, n = high[order], low[order], n[order]
    starts = np.flatnonzero(_changes(high, low))
    return high[starts], low[starts], np.add.reduceat(n, starts) if len(n) else n


def _changes(*keys: np.ndarray) -> np.ndarray:
    """Whether each row begins a run of equal keys."""
    changed = np.zeros(len(keys[0]), bool)
    changed[:1] = True
    for key in keys:
        changed[1:] |= key[1:] != key[:-1]
    return changed


# Vertical partitioning


class _Parted:
    """The groups' first prefixes in order, and the hot prefixes of each length.

    There are at most about two groups for each budget of suffixes, and one hot prefix of a length.
    """

    def __init__(self):
        self.hot: list[np.ndarray] = []  # of each length: the parent's place << 32 | word, sorted
        self.names: list[tuple[int, ...]] = [()]
        self.bounds: list[tuple[int, ...]] = []

    def add(self, marked: list) -> bool:
        """Take in the marked prefixes `(parent, word_id, starts, hot)` of one length; whether any is hot."""
        self.bounds += [(*self.names[r.parent], r.word_id) for r in marked if r.starts]
        hot = sorted((r.parent, r.word_id) for r in marked if r.hot)
        self.names = [(*self.names[parent], word) for parent, word in hot]
        self.hot.append(np.array([parent << 32 | word for parent, word in hot], np.int64))
        return bool(hot)

    def places(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows that begin with a longest hot prefix known, and that prefix's place."""
        place = np.zeros(len(rows), np.int64)
        for length, hot in enumerate(self.hot):
            key = place << 32 | rows[:, length]
            at = np.searchsorted(hot, key)
            at[at == len(hot)] = 0
            held = hot[at] == key if len(hot) else np.zeros(len(rows), bool)
            rows, place = rows[held], at[held]
        return rows, place

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        rows = np.array([(*b, *[0] * (MAX_WORDS - len(b))) for b in sorted(set(self.bounds))], np.int64).reshape(-1, MAX_WORDS)
        return _keys(rows)


def _part(sequences: DataFrame, words: DataFrame, budget: int) -> _Parted:
    """Groups of prefixes within the budget. Only group bounds and hot prefixes reach the driver."""
    parted = _Parted()
    marked = words.where("starts or hot").select(F.lit(0).alias("parent"), F.col("id").alias("word_id"), "starts", "hot")
    more = parted.add(marked.collect())
    while more and len(parted.hot) < MAX_WORDS:
        shared = sequences.sparkSession.sparkContext.broadcast(parted)
        marked = keep(_extend(sequences, shared, len(parted.hot), budget), "prefixes")
        more = parted.add(marked.where("starts or hot").collect())
    return parted


def _extend(sequences: DataFrame, shared, length: int, budget: int) -> DataFrame:
    """The hot prefixes of `length` words with each word that follows, counted and marked."""

    def count(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                rows, place = shared.value.places(_suffixes(_expand(data, np.uint32)))
                key, n = np.unique(place << 32 | rows[:, length], return_counts=True)
                for at in range(0, len(key), 50_000):
                    part = key[at : at + 50_000]
                    yield batch_of(_EXTENDED, part >> 32, part & ((1 << 32) - 1), n[at : at + 50_000])

    def mark(batches):
        marker = _Marker(budget)
        for batch in batches:
            # The last word of a suffix has none after it to be told apart by.
            marks = [marker(f) for f in batch.column(2).to_pylist()]
            yield batch_of(_MARKED, batch.column(0), batch.column(1), [m[0] for m in marks], [m[1] and w > 0 for m, w in zip(marks, batch.column(1).to_pylist())])

    counts = map_arrow(sequences.select("ids"), count, _EXTENDED).groupBy("parent", "word_id").agg(F.sum("n").alias("n"))
    ranged = counts.repartitionByRange("parent", "word_id").sortWithinPartitions("parent", "word_id")
    return map_arrow(ranged, mark, _MARKED)


# Subtrees


def _count(sequences: DataFrame, parted: _Parted, min_count: int) -> DataFrame:
    """The phrases of two words or more that occur `min_count` times: `ids, f`."""
    shared = sequences.sparkSession.sparkContext.broadcast(parted.keys())

    def deal(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                keys = _keys(_suffixes(_expand(data, np.uint32)))
                high, low, n = _merge(*keys, np.ones(len(keys[0]), np.int64))
                cuts = _cuts(high, low, *shared.value)
                for group, (start, end) in enumerate(zip(cuts, cuts[1:])):
                    if end > start:
                        keys = _pack(high[start:end], low[start:end], n[start:end])
                        yield len(keys), (group, keys)

    def subtree(table: pa.Table) -> pa.Table:
        parts = [_unpack(k) for k in table.column("keys").to_pylist()]
        high, low, n = _merge(*(np.concatenate(c) for c in zip(*parts)))
        found = [_nodes(high, low, n, depth, min_count) for depth in range(2, MAX_WORDS + 1)]
        ids, f = [list(i) for part, _ in found for i in part.tolist()], np.concatenate([f for _, f in found])
        return pa.Table.from_batches([batch_of(_NODES, ids, f)])

    dealt = map_arrow(sequences.select("ids"), lambda batches: batches_of(_SUFFIXES, deal(batches)), _SUFFIXES)
    nodes = dealt.groupBy("grp").applyInArrow(subtree, "ids array<bigint>, f bigint")
    return nodes.groupBy("ids").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)


def _cuts(high: np.ndarray, low: np.ndarray, first_high: np.ndarray, first_low: np.ndarray) -> list[int]:
    """Where each group begins among sorted suffixes, and the end."""
    cuts = np.searchsorted(high, first_high)
    for i in np.flatnonzero(first_low):
        end = np.searchsorted(high, first_high[i], "right")
        cuts[i] += np.searchsorted(low[cuts[i] : end], first_low[i])
    return [0, *cuts[1:].tolist(), len(high)]


def _pack(high: np.ndarray, low: np.ndarray, n: np.ndarray) -> bytes:
    """Neighbours differ little, so the words of the first two columns are sent as differences."""
    steps = np.diff(high, prepend=np.uint64(0))
    return _squeeze(np.concatenate([steps, low, n.astype(np.uint64)]))


def _unpack(data: bytes) -> tuple[np.ndarray, ...]:
    steps, low, n = np.split(_expand(data, np.uint64), 3)
    return np.cumsum(steps, dtype=np.uint64), low, n.astype(np.int64)


def _nodes(high: np.ndarray, low: np.ndarray, n: np.ndarray, depth: int, min_count: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of a depth with `min_count` leaves or more below, and the first and last ones, whose
    leaves other groups may share."""
    below = low >> _32 if depth == 3 else low
    starts = np.flatnonzero(_changes(high) if depth == 2 else _changes(high, below))
    f = np.add.reduceat(n, starts)
    wanted = f >= min_count
    wanted[[0, -1]] = True
    words = np.stack([high >> _32, high & _LOW, low >> _32, low & _LOW], axis=1)[starts][:, :depth].astype(np.int64)
    wanted &= words[:, -1] > 0
    return words[wanted], f[wanted]


# Scores


def _scored(nodes: DataFrame, words: DataFrame) -> DataFrame:
    """The candidates that no longer one stands for, with the lowest score over their cuts."""
    counts = nodes.unionAll(words.select(F.array("id").alias("ids"), "f"))
    size = F.size("ids")
    cuts = nodes.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"head": F.slice("ids", F.lit(1), F.col("k")), "tail": F.slice("ids", F.col("k") + 1, size - F.col("k"))})
    cuts = cuts.join(counts.select(F.col("ids").alias("head"), F.col("f").alias("l")), "head")
    cuts = cuts.join(counts.select(F.col("ids").alias("tail"), F.col("f").alias("r")), "tail")
    score = F.expr(f"cast({SCALE} as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    lowest = cuts.groupBy("ids", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    longer = nodes.where(size > 2).select("ids", "f", F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
    longer = longer.select("ids", "f", "m", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)).alias("start"))
    inside = longer.groupBy(F.slice("ids", F.col("start"), F.col("m")).alias("ids")).agg(F.max("f").alias("longest"))
    stood_for = F.expr(f"cast(longest as decimal(19,0)) * 100 >= cast(a as decimal(19,0)) * {CONTAINED}")
    kept = lowest.join(inside, "ids", "left").where(~F.coalesce(stood_for, F.lit(False)))
    return kept.select("ids", "a", "cut.l", "cut.r", "cut.score")


def _rank(scored: DataFrame, words: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    spelled = (
        scored.select("*", F.posexplode("ids").alias("at", "id"))
        .join(words.select("id", "lang", F.col("word").cast("string").alias("word")), "id")
        .groupBy("ids", "lang", "a", "l", "r", "score")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelled"))
    )
    phrase = F.array_join(F.transform("spelled", lambda x: x["word"]), " ")
    phrases = spelled.select("lang", phrase.alias("phrase"), "a", "l", "r", "score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]

    def first(rows: DataFrame, *by: Column | str) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)

    # The first of each share hold the first of all, so no task sorts a whole language.
    shares = first(phrases.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))), "lang", "salt")
    return first(shares.drop("rank", "salt"), "lang").join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
), g AS (
  SELECT lang, m, unnest([array_to_string(ws[i:i + m - 1], ' ') for i in range(1, len(ws) - m + 2)]) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS m)
), f AS (
  SELECT lang, m, phrase, count(*) AS c FROM g GROUP BY lang, m, phrase
), n AS (
  SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang
), k AS (
  SELECT lang, m, phrase, c AS a, string_split(phrase, ' ') AS ws FROM f WHERE m >= 2 AND c >= 30
), u AS (
  SELECT lang, phrase, a, cut, array_to_string(ws[1:cut], ' ') AS head, array_to_string(ws[cut + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, m)) AS cut FROM k)
), s AS (
  SELECT u.lang, u.phrase, a, cut, h.c AS l, t.c AS r, CAST((2000000::HUGEINT * a) // (h.c + t.c)::HUGEINT AS BIGINT) AS score
  FROM u JOIN f h ON h.lang = u.lang AND h.phrase = u.head JOIN f t ON t.lang = u.lang AND t.phrase = u.tail
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), i AS (
  SELECT lang, array_to_string(ws[start:start + size - 1], ' ') AS phrase, max(a) AS longest
  FROM (SELECT *, unnest(range(1, m - size + 2)) AS start FROM (SELECT *, unnest(range(2, m)) AS size FROM k WHERE m > 2))
  GROUP BY ALL
), x AS (
  SELECT b.* FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE longest IS NULL OR 100::HUGEINT * longest < 80::HUGEINT * a
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM x) JOIN n USING (lang)
WHERE rank <= 2000
"""
