"""Byte-level BPE by a table of ranks.

`encode_words` is the native form: higher-order functions fold the ranked merges of each distinct
word, against a literal rank map. `encode` applies the same merges to whole documents. It keeps to
the distinct words of each task and holds what it has merged, as the native fold takes too long for
the words of a large corpus (see README).
"""

from __future__ import annotations

import base64
import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfares.llm.common import batch_of, map_arrow

HELD_WORDS = 300_000
BUCKETS = 1 << 16
NO_RANK = (1 << 31) - 1

_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])
_DIGESTS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
    ]
)

Ranks = dict[bytes, int]


def read_ranks(path: str) -> Ranks:
    """The ranks in a vocabulary file: a piece in base 64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


# Documents


class Encoder:
    """Encodes texts, and holds the ids of up to `HELD_WORDS` words it has met.

    A word is the text of one match of the pattern. The least-ranked pair of neighbouring pieces is
    merged first, the leftmost among equals, until no pair has a rank.
    """

    def __init__(self, ranks: Ranks, pattern: str):
        self.ranks = ranks
        # Blanks are those of Unicode's White_Space.
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.held: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """The ids of `text`, four bytes each, the lowest first."""
        held = self.held
        words = self.pattern.findall(text)
        try:
            return b"".join([held[w] for w in words])
        except KeyError:
            out = []
            for word in words:
                ids = held.get(word)
                if ids is None:
                    if len(held) >= HELD_WORDS:
                        held.clear()
                    ids = held[word] = np.array(self.merge(word.encode()), "<u4").tobytes()
                out.append(ids)
            return b"".join(out)

    def merge(self, word: bytes) -> list[int]:
        ranks = self.ranks
        if word in ranks:
            return [ranks[word]]
        if len(word) > 100:
            return self._merge_long(word)
        parts = [word[i : i + 1] for i in range(len(word))]
        pairs = [ranks.get(word[i : i + 2], NO_RANK) for i in range(len(word) - 1)]
        while pairs:
            low = min(pairs)
            if low == NO_RANK:
                break
            at = pairs.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1], NO_RANK)
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], NO_RANK)
        return [ranks[p] for p in parts]

    def _merge_long(self, word: bytes) -> list[int]:
        """The same merges off a heap, which does not slow down with the square of the length."""
        import heapq

        ranks, n = self.ranks, len(word)
        end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, at, stop = heapq.heappop(heap)
            nxt = after[at]
            if end[at] == 0 or nxt >= n or end[nxt] != stop:
                continue  # a piece of this pair has been merged since
            end[at], after[at], end[nxt] = stop, after[nxt], 0
            if after[at] < n:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < n:
                    until = end[after[left]]
                    rank = ranks.get(word[left:until])
                    if rank is not None:
                        heapq.heappush(heap, (rank, left, until))
        out, at = [], 0
        while at < n:
            out.append(ranks[word[at : end[at]]])
            at = after[at]
        return out

    def decode(self, ids: bytes) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist()])


_encoders: dict[int, Encoder] = {}


def encoder_of(shared) -> Encoder:
    """This worker's encoder of the broadcast `(ranks, pattern)`, kept from task to task."""
    ranks, pattern = shared.value
    known = _encoders.get(id(ranks))
    if known is None or known.ranks is not ranks:
        _encoders.clear()
        known = _encoders[id(ranks)] = Encoder(ranks, pattern)
    return known


def share(spark: SparkSession, ranks: Ranks, pattern: str):
    """Ranks and pattern for all tasks; their size is that of the vocabulary."""
    return spark.sparkContext.broadcast((ranks, pattern))


def encode(docs: DataFrame, ranks: Ranks, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, ids, decoded` of every whole text: its token ids, and the bytes they stand for.

    A null text counts as empty and has no tokens. Rows that repeat an id are encoded each. Other
    columns are not looked at; an empty table gives no rows.
    """

    def rows(encoder: Encoder, doc_ids, texts):
        ids = [encoder.encode(t) for t in texts]
        return batch_of(_ENCODED, doc_ids, _id_lists(ids), [encoder.decode(i) for i in ids])

    return _over(docs, ranks, pattern, doc_id, text, rows, _ENCODED)


def digests(
    docs: DataFrame, ranks: Ranks, pattern: str, doc_id: str = "doc_id", text: str = "text", ids: bool = False
) -> DataFrame:
    """`doc_id, n_tokens, ids_sha256, decoded_sha256` of every text, encoded and decoded as by
    `encode`; ids are hashed as 32-bit numbers, lowest byte first. With `ids`, they come too."""

    def rows(encoder: Encoder, doc_ids, texts):
        found = [encoder.encode(t) for t in texts]
        columns = [
            doc_ids,
            [len(i) // 4 for i in found],
            [hashlib.sha256(i).hexdigest() for i in found],
            [hashlib.sha256(encoder.decode(i)).hexdigest() for i in found],
        ]
        return batch_of(schema, *columns, *([_id_lists(found)] if ids else []))

    schema = _DIGESTS.append(pa.field("ids", pa.list_(pa.int32()))) if ids else _DIGESTS
    return _over(docs, ranks, pattern, doc_id, text, rows, schema)


def _id_lists(found: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(i) // 4 for i in found)], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(found), "<i4")))


def _over(docs, ranks, pattern, doc_id, text, rows, schema):
    shared = share(docs.sparkSession, ranks, pattern)

    def run(batches):
        encoder = encoder_of(shared)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for start in range(0, batch.num_rows, 200):
                yield rows(encoder, batch.column(0).slice(start, 200), texts.slice(start, 200).to_pylist())

    return map_arrow(docs.select(F.col(doc_id).cast("bigint"), F.col(text).cast("string")), run, schema)


# Words, in Spark's own functions


def rank_table(ranks: Ranks, spark: SparkSession) -> Column:
    """A literal: `BUCKETS` maps from a piece in hex to its rank, a piece in the one its hash names.

    Spark looks a key up in a map by going through it, so one map of all ranks would be slow.
    """
    pieces = spark.createDataFrame([(p.hex(), r) for p, r in ranks.items()], "piece string, rank int")
    placed = pieces.select("piece", "rank", _bucket(F.col("piece")).alias("bucket")).collect()
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for row in placed:
        buckets[row.bucket][row.piece] = row.rank
    return F.from_json(F.lit(json.dumps(buckets, separators=(",", ":"))), "array<map<string,int>>")


def _bucket(piece: Column) -> Column:
    return F.pmod(F.xxhash64(piece), F.lit(BUCKETS)).cast("int")


def split_words(text: Column, pattern: str) -> Column:
    """The words of a text, in order."""
    return F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(0))


def encode_words(words: DataFrame, table: Column, word: str = "word") -> DataFrame:
    """`words` with `ids`, the token ids of each word, by a fold over its bytes.

    The state is an array of pieces, each with the rank of its pair with the next. A step merges
    the leftmost pair of the least rank; there are as many steps as bytes, and those left over
    change nothing. A null or empty word has no ids.
    """

    def rank(piece: Column) -> Column:
        return F.coalesce(F.element_at(F.get(table, _bucket(piece)), piece), F.lit(NO_RANK))

    def bind(value: Column, use) -> Column:
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def step(state: Column, _: Column) -> Column:
        def merge(at: Column) -> Column:
            def put(piece: Column) -> Column:
                follows, leads = F.get(state, at + 1)["piece"], F.get(state, at - 2)["piece"]
                pair = F.when(follows.isNull(), NO_RANK).otherwise(rank(F.concat(piece, follows)))
                head = F.struct(leads.alias("piece"), rank(F.concat(leads, piece)).alias("pair"))
                return F.concat(
                    F.slice(state, F.lit(1), F.greatest(at - 2, F.lit(0))),
                    F.filter(F.array(head), lambda x: x["piece"].isNotNull()),
                    F.array(F.struct(piece.alias("piece"), pair.alias("pair"))),
                    F.slice(state, at + 2, F.greatest(F.size(state) - at - 1, F.lit(0))),
                )

            return bind(F.concat(F.get(state, at - 1)["piece"], F.get(state, at)["piece"]), put)

        def least(pairs: Column) -> Column:
            low = F.array_min(pairs)
            return F.when(low == NO_RANK, state).otherwise(bind(F.array_position(pairs, low).cast("int"), merge))

        return bind(F.transform(state, lambda x: x["pair"]), least)

    text = F.coalesce(F.col(word), F.lit(""))
    # The bytes sit in a generator, so that no lambda works them out again.
    row = F.struct(*[F.col(f"`{c}`") for c in words.columns]).alias("row")
    split = words.select(row, F.explode(F.array(F.lower(F.hex(F.encode(text, "UTF-8"))))).alias("hex"))
    n = F.length("hex") / 2

    def byte(i: Column) -> Column:
        pair = F.when(i < n - 1, rank(F.substr("hex", 2 * i + 1, F.lit(4)))).otherwise(NO_RANK)
        return F.struct(F.substr("hex", 2 * i + 1, F.lit(2)).alias("piece"), pair.alias("pair"))

    steps = F.when(n > 1, F.sequence(F.lit(2), n.cast("int"))).otherwise(F.array().cast("array<int>"))
    single = F.transform(F.sequence(F.lit(0), F.greatest(n.cast("int") - 1, F.lit(0))), byte)
    merged = F.transform(F.aggregate(steps, single, step), lambda x: rank(x["piece"]))
    whole = rank(F.col("hex"))
    ids = F.when(n < 1, F.array().cast("array<int>")).when(whole != NO_RANK, F.array(whole)).otherwise(merged)
    return split.select(*[F.col("row").getField(c).alias(c) for c in words.columns if c != "ids"], ids.alias("ids"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(docs, ranks, public_tokenizers.PATTERN)
