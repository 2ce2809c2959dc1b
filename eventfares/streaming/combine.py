"""Map-side combine for streams: add up rows of one key within each task, without state or shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventfares.sources.feeds import ARRIVAL

HELD_ROWS = 200_000
LISTED_ROWS = 1_000


def combine(feed: DataFrame, interval: str, keys: list[str], value: str | None = None) -> DataFrame:
    """Rows with the same interval of arrival and `keys` in one batch become one row.

    It carries their number as `n` and, if a `value` column is named, its sum as `total`; its
    arrival is the start of the interval. Each task adds up what it has read; the sums are brought
    together by key and added up again, so what follows gets one row per key however many tasks
    have read it. (A task that holds more than `HELD_ROWS` keys passes some on early; they count
    like any others.)
    """
    rows = _added_up(feed, interval, keys, value)
    measures = ["n"] if value is None else ["n", "total"]
    return rows.repartition(ARRIVAL, *keys).mapInArrow(_adder([ARRIVAL, *keys], measures), rows.schema)


def combine_lists(feed: DataFrame, interval: str, keys: list[str], per: list[str], salt: Column) -> DataFrame:
    """The rows of `combine` in lists: `rows` of the other keys and `n`, for each arrival, `per` and `_salt`.

    `per` are some of the keys. `salt` is a number by the keys and the arrival, which is the start of
    the interval by then. A list has at most `LISTED_ROWS` rows, so there may be several of one key. A
    join by `per` keeps a row of state for each list, where it would keep one for each row.
    """
    rows = _added_up(feed, interval, keys).withColumn("_salt", salt)
    by = [ARRIVAL, *per, "_salt"]
    listed = [c for c in rows.columns if c not in by]
    schema = rows.select(*by, F.array(F.struct(*listed)).alias("rows")).schema
    return rows.repartition(*by).mapInArrow(_lister(_adder([ARRIVAL, *keys, "_salt"], ["n"]), by, listed), schema)


def _added_up(feed: DataFrame, interval: str, keys: list[str], value: str | None = None) -> DataFrame:
    """What each task has read, added up."""
    measures = {"n": F.lit(1).cast("long")}
    if value is not None:
        feed = feed.where(F.col(value).isNotNull())
        measures["total"] = F.col(value)
    rows = feed.select(
        F.window(ARRIVAL, interval).start.alias(ARRIVAL),
        *keys,
        *[column.alias(name) for name, column in measures.items()],
    )
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    return rows.mapInArrow(_adder([ARRIVAL, *keys], list(measures)), schema)


def _lister(add_up, by: list[str], listed: list[str]):
    def lists(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = pa.Table.from_batches([batch]).sort_by([(c, "ascending") for c in by])
        place = pa.array(np.arange(table.num_rows))
        heads = table.select(by).append_column("_list", pc.divide(place, LISTED_ROWS)).append_column("_place", place)
        # Where a list begins: at another key, or LISTED_ROWS places on.
        firsts = heads.group_by([*by, "_list"], use_threads=False).aggregate([("_place", "min")])["_place_min"].to_numpy()
        firsts = np.sort(firsts)
        columns = {c: table[c].combine_chunks() for c in table.column_names}
        rows = pa.StructArray.from_arrays([columns[c] for c in listed], names=listed)
        ends = pa.array(np.append(firsts, table.num_rows), pa.int32())
        return pa.RecordBatch.from_arrays([*[columns[c].take(pa.array(firsts)) for c in by], pa.ListArray.from_arrays(ends, rows)], names=[*by, "rows"])

    return lambda batches: (lists(batch) for batch in add_up(batches) if batch.num_rows)


def _adder(keys: list[str], measures: list[str]):
    def add_up(parts: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(parts)
        sums = table.group_by(keys, use_threads=False).aggregate([(m, "sum") for m in measures])
        # The result has one `<measure>_sum` per measure, beside the keys.
        columns = [sums[f"{c}_sum" if c in measures else c] for c in table.column_names]
        return pa.table(columns, names=table.column_names).cast(table.schema)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in held) > HELD_ROWS:
                held = [add_up(held)]
                if held[0].num_rows > HELD_ROWS // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from add_up(held).to_batches()

    return per_task
