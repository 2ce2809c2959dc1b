"""Operators over fare tables: one row per route and date, `(start_city, end_city, flight_date, price)`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventfares.functions.scalars import day_range
from eventfares.settings import CAP_FACTOR, keep

ROUTE = ["start_city", "end_city"]
CELL = [*ROUTE, "flight_date"]


def positive(flights: DataFrame, price: str = "price") -> DataFrame:
    """Fares that exist: a price of 0 means no flight."""
    return flights.where(F.col(price) > 0)


def routes(flights: DataFrame) -> DataFrame:
    """The routes that are flown, self-routes left out."""
    return flights.where(F.col("start_city") != F.col("end_city")).select(*ROUTE).distinct()


def served_routes(flights: DataFrame, served: DataFrame) -> DataFrame:
    """Fares on the routes in `served`."""
    return flights.join(served, ROUTE, "left_semi")


def decode_ids(df: DataFrame, names: DataFrame, id_column: str, name_column: str) -> DataFrame:
    """Replace `id_column` by the name that `names(id, name)` gives it, or null if it gives none."""
    lookup = names.select(F.col("id").alias(id_column), F.col("name").alias(name_column))
    return df.join(lookup, id_column, "left").drop(id_column)


def date_spine(df: DataFrame, start: Column, days: Column, name: str = "flight_date") -> DataFrame:
    """One row per day of each row's horizon: its `day_index` from 0, and the calendar date.

    A horizon of no days has no rows.
    """
    return df.select("*", F.posexplode(day_range(start, days.cast("int"))).alias("day_index", name))


def unpivot(
    df: DataFrame, start: Column, prices: str = "prices", price: str = "price"
) -> DataFrame:
    """A price array per row, one element per day from `start`, to one row per existing fare."""
    kept = [c for c in df.columns if c != prices]
    cells = df.select(
        *kept, start.alias("_start"), F.posexplode(prices).alias("_day", price)
    ).withColumn("flight_date", F.date_add("_start", F.col("_day")))
    return positive(cells, price).drop("_start", "_day")


def route_range(flights: DataFrame, price: str = "price") -> DataFrame:
    """Lowest existing fare and highest fare of each route."""
    value = F.col(price)
    return flights.groupBy(*ROUTE).agg(
        F.min(F.when(value > 0, value)).alias("min_price"), F.max(value).alias("max_price")
    )


def with_base(flights: DataFrame, bases: DataFrame) -> DataFrame:
    """Attach each route's base price from `bases(start_city, end_city, base)`, null without one."""
    return flights.join(bases, ROUTE, "left")


def rescale(
    flights: DataFrame, bases: DataFrame, price: str = "price", ranges: DataFrame | None = None
) -> DataFrame:
    """Map each route's existing fares linearly onto [base, 2 * base]; zeros stay.

    A route with a single fare level has no range to map, and one without a base none to map onto:
    both get null. Ranges come from an aggregation, not a window, so no task holds a whole route;
    pass `ranges` if `route_range` of the fares is at hand. They are written first: the planner
    then knows their true size, and broadcasts them or not by it, before it plans the scan of fares.
    """
    ranges = ranges if ranges is not None else route_range(flights, price)
    scale = keep(with_base(ranges, bases), "route-scale")
    low, high, base = (F.col(c).cast("double") for c in ("min_price", "max_price", "base"))
    value = F.col(price)
    span = F.when(high > low, high - low)
    mapped = (base * F.lit(CAP_FACTOR) - base) * (value - low) / span + base
    return flights.join(scale, ROUTE, "left").select(
        *flights.columns,
        F.when(value > 0, mapped).otherwise(value.cast("double")).alias("scaled_price"),
    )


def over_cap(flights: DataFrame, bases: DataFrame, price: str = "price") -> DataFrame:
    """Fares above twice their route's base."""
    return with_base(flights, bases).where(F.col(price) > F.col("base") * CAP_FACTOR)


def cap(flights: DataFrame, bases: DataFrame, price: str = "price") -> DataFrame:
    """Fares with those above twice their route's base lowered to it, as `capped_price`.

    Fares of a route without a base stay as they are.
    """
    limit = F.col("base") * CAP_FACTOR
    return with_base(flights, bases).withColumn("capped_price", F.least(F.col(price), limit))


def diff(old: DataFrame, new: DataFrame, price: str = "price") -> DataFrame:
    """Cells whose fare differs between two snapshots; null marks the side that lacks the cell.

    A snapshot holds a cell once. Both sides go through one grouped union: a single shuffle with a
    map-side combine, in place of an outer join's two sorted ones.
    """
    sides = _side(old, "old_price", price).unionByName(
        _side(new, "new_price", price), allowMissingColumns=True
    )
    return (
        sides.groupBy(*CELL)
        .agg(F.max("old_price").alias("old_price"), F.max("new_price").alias("new_price"))
        .where(~F.col("old_price").eqNullSafe(F.col("new_price")))
    )


def _side(snapshot: DataFrame, name: str, price: str) -> DataFrame:
    return snapshot.select(*CELL, F.col(price).alias(name))


def latest(
    flights: DataFrame, arrival: str, price: str = "price", keys: list[str] | None = None
) -> DataFrame:
    """The most recently arrived fare of each cell; of fares that arrived together, the highest."""
    last = flights.groupBy(*(keys or CELL)).agg(F.max(F.struct(arrival, price)).alias("_last"))
    return last.select(*(keys or CELL), f"_last.{price}", f"_last.{arrival}")


def validity(history: DataFrame, arrival: str = "arrival", price: str = "price") -> DataFrame:
    """Each cell's prices over a series of snapshots: a row for every run of snapshots that follow
    each other with the same price, `first_seen`, `last_seen` and `n_snapshots`.

    `history` has the fares of each snapshot with the time it arrived. A snapshot that lacks a cell
    ends its run, and one that has it twice counts with its highest price. Snapshots are numbered by
    their times alone, of which there is one row each; the runs of a cell are found among its own
    rows, at most one for each snapshot.
    """
    seen = history.groupBy(*CELL, arrival).agg(F.max(price).alias(price))
    times = history.select(arrival).distinct()
    numbers = times.select(F.col(arrival).alias("_time"), F.row_number().over(Window.orderBy(arrival)).alias("_number"))
    numbered = seen.join(numbers, F.col(arrival) == F.col("_time"))
    along = Window.partitionBy(*CELL).orderBy("_number")
    follows = (F.lag("_number").over(along) == F.col("_number") - 1) & F.lag(price).over(along).eqNullSafe(F.col(price))
    started = numbered.withColumn("_starts", F.when(follows, 0).otherwise(1))
    runs = started.withColumn("_run", F.sum("_starts").over(along))
    return (
        runs.groupBy(*CELL, "_run")
        .agg(
            F.max(price).alias(price),
            F.min(arrival).alias("first_seen"),
            F.max(arrival).alias("last_seen"),
            F.count("*").alias("n_snapshots"),
        )
        .drop("_run")
    )
