"""BPE with word ends, by a lexicon of the corpus's frequent words and exact merges of all others.

Words are counted over all documents. The frequent ones are merged once and compiled into an acyclic
transducer (see `lexicon`), a file that Spark ships to every executor and that its workers map. A
word that the lexicon does not hold is merged where it is met.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfares.llm.common import batch_of, map_arrow
from eventfares.llm.lexicon import Lexicon, compile_lexicon
from eventfares.settings import keep, shared_dir

LEXICON_WORDS = 200_000  # bounds what the driver collects, and the size of the file
HELD = 600_000
COUNTED_CHUNKS = 1_000_000
ROWS = 500
NO_RANK = 1 << 31

# The letters and the numbers of Latin-1.
LETTERS = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"

_COUNTS = pa.schema([("word", pa.binary()), ("n", pa.int64())])
_ENTRIES = pa.schema([("word", pa.binary()), ("ids", pa.list_(pa.int32()))])
_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
_DIGESTS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
    ]
)

# Not blanks in Unicode, though `str.split` takes them for such.
_NOT_BLANK = re.compile("[\x1c-\x1f]")
_BLANKS = regex.compile(r"\p{White_Space}+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary's pieces: a printable byte for itself,
    and the others, in order, for the letters from U+0100."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class Model:
    """What a vocabulary file of this kind says: pieces, merges, splitting and special strings."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        read = json.loads(source)
        vocab, merges = read["model"]["vocab"], read["model"]["merges"]
        end = read["model"]["end_of_word_suffix"]
        self.specials = {t["content"]: t["id"] for t in read["added_tokens"]}
        self.pieces = {i: p for p, i in (vocab | self.specials).items()}
        self.letters = _byte_letters()
        self.bytes_of = {letter: b for b, letter in enumerate(self.letters)}
        self.first = [vocab[letter] for letter in self.letters]
        self.last = [vocab[letter + end] for letter in self.letters]
        self.ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(merges)}
        self.made = [vocab[a + b] for a, b in merges]
        # Character classes differ between Unicode versions, and other letters have several forms,
        # so only words of Latin-1 are split here, and all others by the file's own rules.
        rules = Tokenizer.from_str(source)
        self._normal, self._split = rules.normalizer, rules.pre_tokenizer
        pattern = read["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        classes = {r"\p{L}": LETTERS, r"\p{N}": NUMBERS, r"\s": r"\t-\r \x85\xa0"}
        for name, members in classes.items():
            pattern = pattern.replace(name, members)
        self._latin = re.compile(pattern)
        self._special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")")

    def chunks(self, text: str) -> list[str]:
        """The parts of a text between blanks, which no word crosses, and its special strings."""
        if "<|" in text and len(parts := self._special.split(text)) > 1:
            return [c for p in parts for c in ([p] if p in self.specials else self._apart(p))]
        return self._apart(text)

    @staticmethod
    def _apart(text: str) -> list[str]:
        if _NOT_BLANK.search(text):
            return [c for c in _BLANKS.split(text) if c]
        return text.split()

    def words(self, chunk: str) -> list[bytes]:
        """The words of a chunk without special strings, in bytes."""
        if max(chunk) < "\u0100":
            if chunk.isalpha():
                return [chunk.lower().encode()]
            return [w.encode() for w in self._latin.findall(chunk.lower())]
        found = self._split.pre_tokenize_str(self._normal.normalize_str(chunk))
        return [bytes(map(self.bytes_of.__getitem__, word)) for word, _ in found]

    def merge(self, word: bytes) -> list[int]:
        """The ids of a word: the least-ranked neighbours are merged first, the leftmost of equals."""
        ids = [*map(self.first.__getitem__, word[:-1]), self.last[word[-1]]]
        if len(ids) > 100:
            return self._merge_long(ids)
        rank_of, made = self.ranks, self.made
        ranks = [rank_of.get(pair, NO_RANK) for pair in zip(ids, ids[1:])]
        while ranks and (low := min(ranks)) < NO_RANK:
            at = ranks.index(low)
            ids[at : at + 2] = [made[low]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of.get((ids[at], ids[at + 1]), NO_RANK)
            if at:
                ranks[at - 1] = rank_of.get((ids[at - 1], ids[at]), NO_RANK)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same merges off a heap, which does not slow down with the square of the length."""
        import heapq

        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, pair) for i, pair in enumerate(zip(ids, ids[1:])) if (r := self.ranks.get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, at, pair = heapq.heappop(heap)
            follows = after[at]
            if follows >= n or (ids[at], ids[follows]) != pair:
                continue  # one of the two has been merged since
            ids[at], ids[follows], after[at] = self.made[rank], -1, after[follows]
            if after[at] < n:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < n:
                    pair = (ids[left], ids[after[left]])
                    if (r := self.ranks.get(pair)) is not None:
                        heapq.heappush(heap, (r, left, pair))
        return [i for i in ids if i >= 0]


class Encoder:
    """Encodes texts, and holds the ids of up to `HELD` chunks, and as many words, besides those of a
    batch.

    An entry is `(n, ids, ids as text, decoded)` of a chunk or a word, the ids of 32 bits each.
    """

    def __init__(self, model: Model, lexicon: Lexicon):
        self.model, self.lexicon = model, lexicon
        self.chunks: dict[str, tuple] = {}
        self.words: dict[bytes, tuple] = {}

    def encode(self, texts: list[str]) -> list[list[tuple]]:
        """For each text the entries of its chunks."""
        split = [self.model.chunks(t) for t in texts]
        for held in (self.chunks, self.words):
            if len(held) > HELD:
                held.clear()
        self._meet([*set().union(*split).difference(self.chunks)])
        entries = self.chunks
        return [[entries[c] for c in chunks] for chunks in split]

    def _meet(self, chunks: list[str]) -> None:
        model, entries = self.model, self.words
        words = [() if c in model.specials else model.words(c) for c in chunks]
        new = [*set(chain.from_iterable(words)).difference(entries)]
        for word, number in zip(new, self.lexicon.find(new).tolist(), strict=True):
            entries[word] = self._entry(model.merge(word) if number < 0 else self.lexicon.ids_of(number))
        for chunk, parts in zip(chunks, words, strict=True):
            if len(parts) == 1:
                self.chunks[chunk] = entries[parts[0]]
            elif parts:
                n, ids, text, decoded = zip(*[entries[w] for w in parts])
                self.chunks[chunk] = (sum(n), b"".join(ids), " ".join(text), " ".join(decoded))
            else:
                self.chunks[chunk] = self._entry([model.specials[chunk]] if chunk in model.specials else [])

    def _entry(self, ids: list[int]) -> tuple:
        pieces = self.model.pieces
        return len(ids), array("I", ids).tobytes(), " ".join(map(str, ids)), " ".join([pieces[i] for i in ids])


_models: dict[str, Model] = {}
_encoders: dict[tuple, Encoder] = {}


def _model(shared) -> Model:
    """This worker's model of the broadcast vocabulary, kept from task to task."""
    if shared.value not in _models:
        _models.clear()
        _models[shared.value] = Model(shared.value)
    return _models[shared.value]


def _encoder(shared, name: str) -> Encoder:
    model = _model(shared)
    if (name, model) not in _encoders:
        _encoders.clear()
        _encoders[name, model] = Encoder(model, Lexicon.open(SparkFiles.get(name)))
    return _encoders[name, model]


# The lexicon


def count_words(docs: DataFrame, shared, text: str = "text") -> DataFrame:
    """`(word, n)` of every word of every text: counted in tasks, then added up by word."""

    def count(batches):
        model, held = _model(shared), Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.update(model.chunks(t))
            if len(held) > COUNTED_CHUNKS:
                yield from _word_counts(model, held)
                held = Counter()
        yield from _word_counts(model, held)

    texts = docs.select(F.col(text).cast("string")).where(F.col(text).isNotNull())
    return map_arrow(texts, count, _COUNTS).groupBy("word").agg(F.sum("n").alias("n"))


def _word_counts(model: Model, held: Counter):
    counts: Counter = Counter()
    for chunk, n in held.items():
        if chunk not in model.specials:
            for word in model.words(chunk):
                counts[word] += n
    words = [*counts]
    for at in range(0, len(words), 50_000):
        part = words[at : at + 50_000]
        yield batch_of(_COUNTS, part, [counts[w] for w in part])


def frequent(counts: DataFrame, most: int = LEXICON_WORDS) -> DataFrame:
    """The words of the highest counts, at most `most`: whole bands of an eighth of a doubling."""
    banded = counts.withColumn("band", F.floor(F.log2("n") * 8))
    sizes = banded.groupBy("band").agg(F.count("*").alias("words")).orderBy(F.desc("band")).collect()
    total, low = 0, None
    for row in sizes:
        total += row.words
        if total > most:
            break
        low = row.band
    return banded.where(F.lit(False) if low is None else F.col("band") >= low).select("word", "n")


def build_lexicon(docs: DataFrame, shared, text: str = "text", most: int = LEXICON_WORDS) -> bytes:
    """The transducer of the frequent words of all documents.

    Tasks count the words and merge the chosen ones; at most `most` reach the driver.
    """
    chosen = frequent(keep(count_words(docs, shared, text), "word-counts"), most)

    def merge(batches):
        model = _model(shared)
        for batch in batches:
            words = batch.column(0).to_pylist()
            yield batch_of(_ENTRIES, words, [model.merge(w) for w in words])

    merged = map_arrow(chosen.select("word"), merge, _ENTRIES).collect()
    return compile_lexicon({bytes(r.word): r.ids for r in merged})


def ship(spark: SparkSession, data: bytes) -> str:
    """Put `data` where every executor, later ones too, gets it as a file; its name for `SparkFiles`.

    The file stays in the shared folder, named by its content, as Spark cannot take a file back
    that an executor may still ask for.
    """
    name = f"lexicon-{hashlib.sha256(data).hexdigest()[:32]}"
    path = f"{shared_dir(spark).rstrip('/')}/eventfares-lexicons/{name}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        # Written beside, then named, so that a file of that name is whole.
        part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{spark.sparkContext.applicationId}")
        out = files.create(part, True)
        out.write(bytearray(data))
        out.close()
        files.rename(part, at)
    spark.sparkContext.addFile(at.makeQualified(files.getUri(), files.getWorkingDirectory()).toString())
    return name


# Documents


def encode(docs: DataFrame, source: str, doc_id: str = "doc_id", text: str = "text", most: int = LEXICON_WORDS) -> DataFrame:
    """`doc_id, ids, decoded` of every whole text, by the vocabulary file whose content is `source`.

    Special strings in a text become their ids; none are added. Decoding joins the pieces with
    blanks, word ends included. A null text counts as empty and has no tokens. Rows that repeat an
    id are encoded each. Other columns are not looked at; an empty table gives no rows. `most`
    bounds the lexicon, which decides what is looked up and what is merged, and no result.
    """

    def rows(found, doc_ids):
        ids = [np.frombuffer(b"".join([c[1] for c in chunks]), np.int32) for chunks in found]
        return batch_of(_ENCODED, doc_ids, ids, [_joined(chunks, 3) for chunks in found])

    return _over(docs, source, doc_id, text, most, rows, _ENCODED)


def digests(docs: DataFrame, source: str, doc_id: str = "doc_id", text: str = "text", most: int = LEXICON_WORDS) -> DataFrame:
    """`doc_id, n_tokens, ids_sha256, decoded_sha256` of every text, encoded and decoded as by
    `encode`; ids are hashed as decimals joined by one blank."""

    def sha(value: str) -> str:
        return hashlib.sha256(value.encode()).hexdigest()

    def rows(found, doc_ids):
        return batch_of(
            _DIGESTS,
            doc_ids,
            [sum([c[0] for c in chunks]) for chunks in found],
            [sha(_joined(chunks, 2)) for chunks in found],
            [sha(_joined(chunks, 3)) for chunks in found],
        )

    return _over(docs, source, doc_id, text, most, rows, _DIGESTS)


def _joined(chunks: list[tuple], field: int) -> str:
    return " ".join([c[field] for c in chunks if c[0]])


def _over(docs, source, doc_id, text, most, rows, schema):
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(source)  # of the size of a vocabulary
    name = ship(spark, build_lexicon(docs, shared, text, most))

    def run(batches):
        encoder = _encoder(shared, name)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for start in range(0, batch.num_rows, ROWS):
                found = encoder.encode(texts.slice(start, ROWS).to_pylist())
                yield rows(found, batch.column(0).slice(start, ROWS))

    return map_arrow(docs.select(F.col(doc_id).cast("bigint"), F.col(text).cast("string")), run, schema)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        source = file.read()
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), source)
