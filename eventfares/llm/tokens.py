"""Token counts by section, from one encoding of each whole document."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfares.llm.bpe import Encoder, Ranks, encoder_of, read_ranks, share
from eventfares.llm.common import batch_of, map_arrow

# Starts and ends, in characters, of sections in order that do not overlap.
Spans = tuple[np.ndarray, np.ndarray]

OUTSIDE = -1
ROWS = 20_000

_COUNTS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("section", pa.int32()),
        ("n_chars", pa.int64()),
        ("n_tokens", pa.int64()),
        ("n_crossing", pa.int64()),
    ]
)


def lines_of(text: str) -> Spans:
    """Lines as sections, each with the line feed that ends it. An empty text is one empty line."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    ends = np.append(np.nonzero(points == 10)[0] + 1, len(points))
    return np.append(0, ends[:-1]), ends


def token_spans(encoder: Encoder, text: str) -> Spans:
    """The characters of each token. A token of part of a character spans that character."""
    ids = np.frombuffer(encoder.encode(text), "<u4")
    lengths = encoder.lengths[ids]
    ends = np.cumsum(lengths)
    data = np.frombuffer(text.encode(), np.uint8)
    # The number of the character that each byte belongs to.
    number = np.cumsum((data & 0xC0) != 0x80) - 1
    return number[ends - lengths], number[ends - 1] + 1


def allocate(tokens: Spans, sections: Spans) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token, and whether the token crosses a boundary.

    A token goes to the section that holds the most of its characters, the earlier one if two hold
    as many, and to `OUTSIDE` if none holds any.
    """
    (start, end), (s_start, s_end) = tokens, sections
    first = np.searchsorted(s_end, start, "right")
    last = np.searchsorted(s_start, end, "left") - 1
    place = np.where(first > last, OUTSIDE, first)
    inside = place != OUTSIDE
    held = np.clip(first, 0, max(len(s_start) - 1, 0))
    crossing = inside & ((start < s_start[held]) | (end > s_end[held])) if len(s_start) else inside
    for t in np.nonzero(crossing & (last > first))[0]:
        near = np.arange(first[t], last[t] + 1)
        overlap = np.minimum(s_end[near], end[t]) - np.maximum(s_start[near], start[t])
        place[t] = near[overlap.argmax()] if overlap.max() > 0 else OUTSIDE
    return place, crossing


def count_tokens(
    docs: DataFrame,
    ranks: Ranks,
    pattern: str,
    sections: Callable[[str], Spans] = lines_of,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document and section: `doc_id, section, n_chars, n_tokens, n_crossing`.

    Each whole text is encoded once and its tokens are allocated by `allocate`, so the sections of a
    document add up to its tokens; `n_crossing` of them cross a boundary. Tokens outside all sections
    are counted under section -1. A null text counts as empty. Rows that repeat an id each have
    their own rows. Other columns are not looked at; an empty table gives no rows.
    """
    shared = share(docs.sparkSession, ranks, pattern)

    def run(batches):
        encoder = encoder_of(shared)
        held, n = [], 0
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for doc, value in zip(batch.column(0).to_pylist(), texts, strict=True):
                held.append((doc, *_count(encoder, value.as_py(), sections)))
                n += len(held[-1][1])
                if n >= ROWS:
                    yield _rows(held)
                    held, n = [], 0
        if held:
            yield _rows(held)

    return map_arrow(docs.select(F.col(doc_id).cast("bigint"), F.col(text).cast("string")), run, _COUNTS)


def _count(encoder: Encoder, text: str, sections) -> tuple[np.ndarray, ...]:
    starts, ends = sections(text)
    place, crossing = allocate(token_spans(encoder, text), (starts, ends))
    n = len(starts)
    # The last cell is for tokens outside.
    tokens = np.bincount(np.where(place < 0, n, place), minlength=n + 1)
    crossed = np.bincount(np.where(place < 0, n, place)[crossing], minlength=n + 1)
    kept = np.arange(n if tokens[n] == 0 else n + 1)
    names = np.where(kept == n, OUTSIDE, kept)
    chars = np.append(ends - starts, 0)
    return names, chars[kept], tokens[kept], crossed[kept]


def _rows(held) -> pa.RecordBatch:
    ids = [doc for doc, names, *_ in held for _ in range(len(names))]
    return batch_of(_COUNTS, ids, *(np.concatenate([h[k] for h in held]) for k in range(1, 5)))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, ranks, public_tokenizers.PATTERN)
