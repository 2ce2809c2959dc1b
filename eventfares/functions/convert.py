"""Declared models: which nested value becomes which column, how it is typed, and its default.

A model is a tuple of `Field`s. `columns` turns it into column expressions over a struct, so that a
nested record is flattened, converted and completed in one projection.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the listing pages.
DATE_FORMAT = "yyyy-MM-dd"
TIME_PATTERN = r"^([01]?\d|2[0-3]):[0-5]?\d:([0-5]?\d|6[01])$"

PATH_MARK = "__"


@dataclass(frozen=True)
class Field:
    """One column: `path` names the source (`a__b` is b inside a), by default the column's name."""

    name: str
    kind: str = "raw"
    path: str | None = None
    default: object = None
    model: tuple[Field, ...] | None = None


def to_date(value: Column) -> Column:
    return F.try_to_date(value, DATE_FORMAT)


def to_instant(value: Column) -> Column:
    """A date and time in any ISO spelling, with or without an offset: `2018-11-16T20:00:00+0100`,
    `2018-11-16 20:00`, `2018-11-16`. Others are failures, see `failures`."""
    return F.try_to_timestamp(value)


def to_time(value: Column) -> Column:
    """The text itself if it is a time of day, else null."""
    return F.when(value.rlike(TIME_PATTERN), value)


_CONVERSIONS: dict[str, Callable[[Column], Column]] = {
    "raw": lambda c: c,
    "string": lambda c: c.cast("string"),
    "boolean": lambda c: c != 0,
    "int": lambda c: c.try_cast("int"),
    "decimal": lambda c: c.cast("string").try_cast("decimal(38,18)"),
    "date": to_date,
    "datetime": to_instant,
    "time": to_time,
}


def columns(model: tuple[Field, ...], record: Column | None = None) -> list[Column]:
    """The model's columns, read from `record`, or from the row itself."""
    return [_column(field, record).alias(field.name) for field in model]


def failures(model: tuple[Field, ...], record: Column | None = None, prefix: str = "") -> Column:
    """Names, with dots, of the model's fields that had a value which did not convert, as an array."""
    found = [
        F.array(*[
            F.when(value.isNotNull() & _CONVERSIONS[field.kind](value).isNull(), f"{prefix}{field.name}")
            for field in model
            if field.kind in _CONVERSIONS
            for value in [_source(field, record)]
        ])
    ]
    for field in model:
        if field.model:
            value, inside = _source(field, record), f"{prefix}{field.name}."
            if field.kind == "list":
                each = _failures_in_list(field.model, value, inside)
            else:
                each = F.when(value.isNotNull(), failures(field.model, value, inside))
            found.append(F.coalesce(each, F.array().cast("array<string>")))
    return F.array_distinct(F.array_compact(F.concat(*found)))


def _failures_in_list(model: tuple[Field, ...], value: Column, prefix: str) -> Column:
    return F.flatten(F.transform(value, lambda item: failures(model, item, prefix)))


def _source(field: Field, record: Column | None) -> Column:
    first, *rest = (field.path or field.name).split(PATH_MARK)
    value = F.col(first) if record is None else record[first]
    for step in rest:
        value = value[step]
    return value


def _column(field: Field, record: Column | None) -> Column:
    value = _source(field, record)
    if field.kind == "list":
        return _list(field, value)
    if field.kind == "object":
        converted = _object(field.model, value)
    else:
        converted = _CONVERSIONS[field.kind](value)
    return converted if field.default is None else F.coalesce(converted, F.lit(field.default))


def _object(model: tuple[Field, ...], value: Column) -> Column:
    return F.when(value.isNotNull(), F.struct(*columns(model, value)))


def _list(field: Field, value: Column) -> Column:
    items = F.transform(value, lambda v: _object(field.model, v)) if field.model else value
    return F.coalesce(items, F.array())
