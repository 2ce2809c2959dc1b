"""Feed lines to typed records. A line that does not fit is marked, never fatal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventfares.functions.convert import DATE_FORMAT
from eventfares.functions.scalars import once
from eventfares.schemas import CONCERTS, CORRUPT, FLIGHTS

CSV_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "dateFormat": DATE_FORMAT,
}


def concerts(lines: DataFrame, line: str = "value") -> DataFrame:
    """`concert_id,artist,event_date,event_city` lines, typed."""
    return _parse(lines, CONCERTS, line)


def flights(lines: DataFrame, line: str = "value") -> DataFrame:
    """`start_city,end_city,flight_date,price` lines, typed."""
    return _parse(lines, FLIGHTS, line)


def accepted(records: DataFrame) -> DataFrame:
    """The records that parsed, without the marker column."""
    return records.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected(records: DataFrame) -> DataFrame:
    """The lines that did not parse, as `line`, with whatever came along (such as arrival)."""
    extra = [c for c in records.columns if c not in _field_names(records) and c != CORRUPT]
    return records.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"), *extra)


def complete(records: DataFrame, schema: str, line: Column) -> DataFrame:
    """Fill absent text with the empty string, and mark records that lack any other field.

    The marker holds `line`, the text of the record.
    """
    fields = T.StructType.fromDDL(schema).fields
    typed = [f.name for f in fields if not isinstance(f.dataType, T.StringType)]
    lacking = F.lit(False)
    for name in typed:
        lacking = lacking | F.col(name).isNull()
    text = {
        f.name: F.coalesce(f.name, F.lit(""))
        for f in fields
        if isinstance(f.dataType, T.StringType)
    }
    marked = F.when(F.col(CORRUPT).isNotNull() | lacking, F.coalesce(line, F.lit("")))
    return records.withColumns({CORRUPT: marked, **text})


def _parse(lines: DataFrame, schema: str, line: str) -> DataFrame:
    others = [c for c in lines.columns if c != line]
    # Empty trailing fields do not count, as with a split that drops them.
    text = F.regexp_replace(line, ",+$", "")
    record = once(F.from_csv(text, f"{schema}, {CORRUPT} string", CSV_OPTIONS)).alias("_record")
    records = lines.select(line, *others, record).select(line, *others, "_record.*")
    names = T.StructType.fromDDL(schema).fieldNames()
    return complete(records, schema, F.col(line)).select(*names, CORRUPT, *others)


def _field_names(records: DataFrame) -> set[str]:
    known = T.StructType.fromDDL(CONCERTS).fieldNames() + T.StructType.fromDDL(FLIGHTS).fieldNames()
    return set(known)
