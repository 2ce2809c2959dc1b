"""Every operator at work on the given tables: name -> query(spark, sf_dir).

Dates leave as ISO text, as they do in the result documents.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfares.functions.scalars import compact_stamp, zero_below
from eventfares.operators import aggs, events, fares, joins, ordering
from eventfares.plans import batch, tables
from eventfares.plans import concert_feed as feed_plan
from eventfares.settings import FARE_DAYS, keep, new_path
from eventfares.sources import feeds, pages, parse, sinks
from eventfares.streaming import join as stream_join
from eventfares.streaming import averages, late, latest, run, state

CENTS = 100.0
SNAPSHOT_TIME = datetime(2018, 10, 31, tzinfo=timezone.utc)
SEARCH_DATES = ("1997-03-01", "1999-02-28")
AS_OF = "1999-01-01"
# Feeds of a stream on the given tables arrive on their own dates, and meet month by month.
STREAM_INTERVAL = "30 days"
STREAM_DELAY = "36500 days"  # the tables are in no order of arrival: nothing may count as late
DOCUMENT_BATCHES = 6


def _text_dates(df: DataFrame) -> DataFrame:
    dates = [f.name for f in df.schema.fields if f.dataType.typeName() == "date"]
    return df.withColumns({d: F.col(d).cast("string") for d in dates})


def _cents_flights(spark, sf_dir, *also):
    return tables.flights(spark, sf_dir, *also).drop("price")


def _ranges_and_bases(flights: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fare ranges of routes, and a stand-in for the table of base prices, which is input.

    A base is the lowest fare; routes from NATION_3 have none.
    """
    ranges = keep(fares.route_range(flights, "cents"), "ranges")
    known = ranges.where("start_city <> 'NATION_3'")
    return ranges, known.select(*fares.ROUTE, F.col("min_price").alias("base"))


# Averages and joins


def event_fare_avg(spark, sf_dir):
    concerts, arrivals = tables.concerts(spark, sf_dir), tables.arrivals(spark, sf_dir)
    return _text_dates(aggs.event_fare_avg(concerts, arrivals, "cents", CENTS))


def city_totals(spark, sf_dir):
    concerts, arrivals = tables.concerts(spark, sf_dir), tables.arrivals(spark, sf_dir)
    return joins.city_totals(concerts, arrivals, "cents")


def event_flights_window(spark, sf_dir):
    """All fares by the concert dates they serve, with the number of concerts."""
    flights = _cents_flights(spark, sf_dir, "l_orderkey", "l_linenumber")
    return _text_dates(joins.fares_by_event_date(tables.concerts(spark, sf_dir), flights))


def concert_flights(spark, sf_dir):
    """The concerts of one artist, each with its fares."""
    artist = tables.table(spark, sf_dir, "customer").where("c_custkey = 1").select(F.col("c_name").alias("artist"))
    concerts = tables.concerts(spark, sf_dir).join(artist, "artist", "left_semi")
    flights = _cents_flights(spark, sf_dir, "l_orderkey", "l_linenumber")
    return _text_dates(joins.event_flights_window(concerts, flights))


def to_documents(spark, sf_dir):
    concerts, arrivals = tables.concerts(spark, sf_dir), tables.arrivals(spark, sf_dir)
    return sinks.to_documents(aggs.event_fare_avg(concerts, arrivals, "cents", CENTS))


# Operators along an order


def running_avg(spark, sf_dir):
    amounts = tables.amounts(spark, sf_dir)
    return ordering.running_avg(amounts, ["user_id"], ["event_id"], "cents", CENTS)


def running_avg_split(spark, sf_dir):
    """The same in so many ranges that most users' events lie in several."""
    amounts = tables.amounts(spark, sf_dir)
    return ordering.running_avg(amounts, ["user_id"], ["event_id"], "cents", CENTS, parts=200)


def number_rows(spark, sf_dir):
    concerts = tables.concerts(spark, sf_dir).withColumnRenamed("concert_id", "order_id")
    return _text_dates(ordering.number_rows(concerts, "artist", "order_id"))


# Fare tables


def positive_fares(spark, sf_dir):
    """Events' amounts as presence draws: those under the threshold mean no fare."""
    drawn = tables.table(spark, sf_dir, "events").select(
        "event_id", zero_below(F.col("value") / 100).alias("presence")
    )
    return fares.positive(drawn, "presence")


def routes(spark, sf_dir):
    return fares.routes(tables.flights(spark, sf_dir))


def served_routes(spark, sf_dir):
    flights = _cents_flights(spark, sf_dir, "l_orderkey", "l_linenumber", "l_returnflag")
    returned = flights.where("l_returnflag = 'R' and cents > 9500000")
    return _text_dates(fares.served_routes(flights, fares.routes(returned)).drop("l_returnflag"))


def date_spine(spark, sf_dir):
    first = tables.concerts(spark, sf_dir).groupBy("event_city").agg(
        F.min("event_date").alias("first_date")
    )
    spine = fares.date_spine(first, F.col("first_date"), F.lit(FARE_DAYS), "spine_date")
    return _text_dates(spine)


def unpivot_fares(spark, sf_dir):
    """Daily totals of fares per city, packed into one array over the city's dates, and taken apart again."""
    daily = (
        tables.arrivals(spark, sf_dir)
        .groupBy("end_city", "flight_date")
        .agg(F.sum("cents").alias("cents"))
    )
    spans = daily.groupBy("end_city").agg(
        F.min("flight_date").alias("first_date"), F.max("flight_date").alias("last_date")
    )
    days = F.datediff("last_date", "first_date") + 1
    spine = fares.date_spine(spans, F.col("first_date"), days)
    # One row per calendar day, so an array is as long as the city's span of dates.
    packed = (
        spine.join(daily, ["end_city", "flight_date"], "left")
        .groupBy("end_city", "first_date")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("day_index", F.coalesce("cents", F.lit(0)).alias("cents")))
            ).alias("cells")
        )
        .select("end_city", "first_date", F.col("cells.cents").alias("prices"))
    )
    rows = fares.unpivot(packed, F.col("first_date"), price="cents").drop("first_date")
    return _text_dates(rows)


def decode_ids(spark, sf_dir):
    """Customers by nation and region id, with both ids then replaced by names, some unknown."""
    nation = tables.table(spark, sf_dir, "nation")
    sales = (
        tables.table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_nationkey").alias("city_id"), F.col("n_regionkey").alias("region_id"))
        .agg(F.count("*").alias("n"))
    )
    known = nation.where("n_nationkey < 20")
    cities = known.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    regions = tables.table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")
    )
    named = fares.decode_ids(sales, cities, "city_id", "city")
    return fares.decode_ids(named, regions, "region_id", "region")


def route_range(spark, sf_dir):
    return fares.route_range(tables.flights(spark, sf_dir), "cents")


def rescale_fares(spark, sf_dir):
    flights = _cents_flights(spark, sf_dir, "l_orderkey", "l_linenumber")
    ranges, bases = _ranges_and_bases(flights)
    return _text_dates(fares.rescale(flights, bases, "cents", ranges))


def over_cap(spark, sf_dir):
    flights = _cents_flights(spark, sf_dir, "l_orderkey", "l_linenumber")
    return _text_dates(fares.over_cap(flights, _ranges_and_bases(flights)[1], "cents"))


def cap_fares(spark, sf_dir):
    flights = _cents_flights(spark, sf_dir, "l_orderkey", "l_linenumber")
    return _text_dates(fares.cap(flights, _ranges_and_bases(flights)[1], "cents"))


def _snapshots(spark, sf_dir):
    """Highest fare per cell over all lines but the returned ones, and over all but the accepted."""
    flights = _cents_flights(spark, sf_dir, "l_returnflag")

    def snapshot(condition):
        return flights.where(condition).groupBy(*fares.CELL).agg(F.max("cents").alias("cents"))

    return snapshot("l_returnflag <> 'R'"), snapshot("l_returnflag <> 'A'")


def fare_diff(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return _text_dates(fares.diff(old, new, "cents"))


def fare_changes(spark, sf_dir):
    old, new = (s.withColumn("price", F.col("cents") / 100) for s in _snapshots(spark, sf_dir))
    return _text_dates(sinks.fare_changes(fares.diff(old, new)))


def latest_fare(spark, sf_dir):
    amounts = tables.amounts(spark, sf_dir)
    return fares.latest(amounts, "event_id", "cents", ["user_id", "event_type"])


# Feeds


def city_list(spark, sf_dir):
    """Concerts in European cities, the cities read from a list file."""
    region = tables.table(spark, sf_dir, "region").where("r_name = 'EUROPE'")
    names = tables.table(spark, sf_dir, "nation").join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    path = new_path(spark, "cities")
    names.select(F.col("n_name").alias("value")).write.text(path)
    concerts = tables.concerts(spark, sf_dir)
    return _text_dates(
        events.in_cities(concerts, feeds.read_cities(spark, path), F.col("event_city"))
    )


def city_in(spark, sf_dir):
    cities = ["NATION_2", "NATION_3", "NATION_5", "NATION_7"]
    return _text_dates(
        events.in_cities(tables.concerts(spark, sf_dir), cities, F.col("event_city"))
    )


def concert_csv(spark, sf_dir):
    """Concerts with long ids as CSV with a header and quoted "City, Region" values, and read back."""
    home = tables.table(spark, sf_dir, "nation").join(
        tables.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    full = tables.concerts(spark, sf_dir).join(home, F.col("event_city") == F.col("n_name"))
    path = new_path(spark, "concert-csv")
    city = F.concat_ws(", ", "n_name", "r_name").alias("city")
    wide = (F.col("concert_id") * 10_000_000_000).alias("concert_id")
    records = full.select(wide, "artist", F.col("event_date").alias("date"), city)
    records.write.option("header", True).csv(path)
    return _text_dates(parse.accepted(feeds.read_concerts(spark, path)))


def parse_quarantine(spark, sf_dir):
    """Concert lines among lines of prose: what parses, per city, and how much does not."""
    lines = tables.concerts(spark, sf_dir).select(
        F.concat_ws(",", "concert_id", "artist", "event_date", "event_city").alias("value")
    )
    prose = tables.table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    records = parse.concerts(lines.unionByName(prose))
    bad = F.col("_corrupt_record").isNotNull()
    return (
        records.groupBy(
            F.when(bad, "rejected").otherwise("accepted").alias("kind"),
            F.when(~bad, F.col("event_city")).alias("event_city"),
        )
        .agg(
            F.count("*").alias("n"),
            F.sum(F.when(~bad, F.col("concert_id").cast("long"))).alias("id_sum"),
            F.min(F.when(~bad, F.col("event_date"))).cast("string").alias("first_date"),
        )
    )


def fare_feed(spark, sf_dir):
    """Fares written as a feed snapshot at whole prices, then read back as what is recent."""
    path = new_path(spark, "fare-feed")
    sinks.write_feed(sinks.fare_snapshot(tables.flights(spark, sf_dir)), path, SNAPSHOT_TIME)
    lines = feeds.recent_files(feeds.feed_lines(spark, path), SNAPSHOT_TIME)
    return _fare_totals(parse.accepted(parse.flights(lines)))


def _fare_totals(flights):
    return flights.groupBy("start_city", "end_city").agg(
        F.count("*").alias("n"), F.sum(F.col("price").cast("long")).alias("total")
    )


def _feed_snapshots(spark, sf_dir):
    """A full snapshot, one of returned fares, and the changes from the first to the second."""
    old, new = (s.withColumn("price", F.col("cents") / 100) for s in _snapshots(spark, sf_dir))
    return sinks.fare_snapshot(old), sinks.fare_snapshot(new), sinks.fare_changes(fares.diff(old, new))


def _write_snapshots(spark, sf_dir, path):
    """An expired snapshot of returned fares, a full one, and the changes to it, as one feed."""
    old, new, changes = _feed_snapshots(spark, sf_dir)
    second = timedelta(seconds=1)
    sinks.write_feed(new, path, SNAPSHOT_TIME - 300 * second)
    sinks.write_feed(old, path, SNAPSHOT_TIME - 100 * second)
    sinks.write_feed(changes, path, SNAPSHOT_TIME)


def snapshot_and_changes(spark, sf_dir):
    """A full snapshot and its changes read as one feed, without the snapshot that has expired."""
    path = new_path(spark, "fare-snapshots")
    _write_snapshots(spark, sf_dir, path)
    lines = feeds.recent_files(feeds.feed_lines(spark, path), SNAPSHOT_TIME)
    return _fare_totals(parse.accepted(parse.flights(lines)))


def _average_fares(spark, sf_dir, latest_only):
    base = new_path(spark, "both-feeds")
    concerts = sinks.concert_snapshot(tables.concerts(spark, sf_dir))
    for seconds in (0, 20):
        sinks.write_feed(concerts, f"{base}/concerts", SNAPSHOT_TIME + timedelta(seconds=seconds))
    _write_snapshots(spark, sf_dir, f"{base}/fares")
    averages = batch.average_fares(spark, f"{base}/concerts", f"{base}/fares", latest_only)
    return _text_dates(averages)


def average_fares(spark, sf_dir):
    """The average over both feeds, in which every repeat counts."""
    return _average_fares(spark, sf_dir, latest_only=False)


def average_fares_latest(spark, sf_dir):
    """The average with each concert once and each fare at its latest price."""
    return _average_fares(spark, sf_dir, latest_only=True)


def stream_feeds(spark, sf_dir):
    """Both feeds written as CSV among lines of prose, and read as streams of records."""
    base = new_path(spark, "feeds")
    concerts = tables.concerts(spark, sf_dir)
    flights = sinks.fare_snapshot(tables.flights(spark, sf_dir))
    prose = tables.table(spark, sf_dir, "documents").select(F.regexp_replace("text", r"\s", " "))
    for name, records in (("concerts", sinks.concert_snapshot(concerts)), ("fares", flights)):
        sinks.write_feed(records, f"{base}/{name}", SNAPSHOT_TIME)
        prose.write.text(f"{base}/{name}/prose")

    read = {
        "concerts": (feeds.read_concerts_stream, "event_city"),
        "fares": (feeds.read_flights_stream, "end_city"),
    }
    for name, (reader, city) in read.items():
        bad = F.col("_corrupt_record").isNotNull()
        rows = reader(spark, f"{base}/{name}").select(
            F.lit(name).alias("feed"),
            F.when(bad, "rejected").otherwise("accepted").alias("kind"),
            F.when(~bad, F.col(city)).alias("city"),
        )
        writer = rows.writeStream.format("parquet").option("path", f"{base}/read-{name}")
        run.run_once(writer, f"{base}/checkpoints/{name}")
    both = spark.read.parquet(f"{base}/read-concerts").unionByName(
        spark.read.parquet(f"{base}/read-fares")
    )
    return both.groupBy("feed", "kind", "city").agg(F.count("*").alias("n"))


# Listing pages


def _read_events(spark, sf_dir):
    return _write_pages(spark, tables.event_bodies(spark, sf_dir))[0]


def _write_pages(spark, bodies):
    path = new_path(spark, "event-pages")
    bodies.write.text(path)
    return pages.read_event_pages(spark, path)


def event_pages(spark, sf_dir):
    """Pages written as text, read, and flattened by the declared model."""
    flat = events.flatten(_read_events(spark, sf_dir), events.EVENT_MODEL)
    return flat.select(
        "id",
        "status",
        "event_type",
        "display_name",
        (F.col("popularity") * 100).cast("long").alias("popularity"),
        F.col("series.display_name").alias("series"),
        F.col("venue.display_name").alias("venue"),
        F.col("venue.metro_area.country").alias("country"),
        F.col("location.city").alias("location"),
        F.col("event_start.date").cast("string").alias("start_date"),
        F.col("event_start.time").alias("start_time"),
        F.date_format("event_start.datetime", "yyyy-MM-dd HH:mm:ss").alias("start_utc"),
        F.size("artists").cast("long").alias("n_artists"),
        F.get("artists", F.lit(1))["display_name"].alias("second_artist"),
        F.get("artists", F.lit(0))["identifiers"][1]["musicbrainz_id"].alias("second_mbid"),
        F.col("event_end").isNull().alias("one_day"),
    )


def unconverted(spark, sf_dir):
    """Events whose times are not times of day, by the fields that did not convert."""
    bodies = tables.event_bodies(spark, sf_dir).select(
        F.regexp_replace("body", '"time":"20:00:00"', '"time":"8pm"').alias("body")
    )
    flat = events.flatten(_write_pages(spark, bodies)[0], events.EVENT_MODEL, failed="failed")
    return flat.groupBy(F.array_join("failed", ",").alias("failed")).agg(F.count("*").alias("n"))


def page_rejects(spark, sf_dir):
    """Event pages among prose, and among JSON that is no page."""
    text = F.regexp_replace("text", r"\s", " ")
    docs = tables.table(spark, sf_dir, "documents")
    bodies = (
        tables.event_bodies(spark, sf_dir)
        .unionByName(docs.select(text.alias("body")))
        .unionByName(docs.select(F.to_json(F.struct("doc_id", text.alias("text"))).alias("body")))
    )
    good, bad = _write_pages(spark, bodies)
    return good.agg(F.lit("none").alias("reason"), F.count("*").alias("n")).unionByName(
        bad.groupBy("reason").agg(F.count("*").alias("n"))
    )


def page_items(spark, sf_dir):
    """Event and setlist pages on which every third item has a field of another type."""
    event_page = r'"venue":\{"id":(\d*[369]),'
    bodies = tables.event_bodies(spark, sf_dir).select(
        F.regexp_replace("body", event_page, '"venue":{"id":"x$1",').alias("body")
    )
    good, bad = _write_pages(spark, bodies)
    path = new_path(spark, "setlist-pages")
    spoiled = F.when(F.col("event_id") % 3 == 0, F.regexp_replace("body", '"encore":1', '"encore":true'))
    setlists = tables.setlist_bodies(spark, sf_dir).select("event_id", F.coalesce(spoiled, "body").alias("body"))
    # The event stands in each line: a folder for each would make as many files as there are events.
    setlists.write.json(path)
    sets, bad_sets = pages.read_setlist_pages(spark, path, request="event_id bigint")
    parts = {"event": good, "setlist": sets}
    rows = [df.agg(F.lit(name).alias("kind"), F.lit("none").alias("reason"), F.count("*").alias("n"), F.sum("id").alias("ids")) for name, df in parts.items()]
    rows += [
        df.groupBy(F.lit(name).alias("kind"), "reason").agg(
            F.count("*").alias("n"), F.sum(F.get_json_object("body", "$.id").cast("long")).alias("ids")
        )
        for name, df in (("event", bad), ("setlist", bad_sets))
    ]
    return reduce(DataFrame.unionByName, rows)


def event_search(spark, sf_dir):
    """Events of the artists of one market segment, between two dates."""
    artists = tables.table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("list_position"), F.col("c_name").alias("artist")
    )
    found = events.search(_read_events(spark, sf_dir), artists, *SEARCH_DATES)
    return found.select("id", "list_position", F.col("start.date").alias("start_date"))


def concert_feed(spark, sf_dir):
    """The whole feed: pages, search, city list, numbering, CSV snapshot, and the snapshot read."""
    artists = tables.table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("list_position"), F.col("c_name").alias("artist")
    )
    region = F.concat_ws(", ", "n_name", "r_name").alias("city")
    cities = (
        tables.table(spark, sf_dir, "nation")
        .join(tables.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .where("r_name = 'EUROPE'")
        .select(region)
    )
    concerts = feed_plan.concerts_from(_read_events(spark, sf_dir), artists, cities, *SEARCH_DATES)
    path = new_path(spark, "concert-feed")
    feed_plan.publish(concerts, path, SNAPSHOT_TIME)
    read = parse.accepted(parse.concerts(feeds.feed_lines(spark, path)))
    return _text_dates(read.drop(feeds.ARRIVAL))


def active_events(spark, sf_dir):
    found = events.active(_read_events(spark, sf_dir))
    return found.select("id", "displayName")


def by_mbid(spark, sf_dir):
    segment = hashlib.md5(b"BUILDING").hexdigest()
    found = events.by_mbid(_read_events(spark, sf_dir), segment)
    return found.select("id", "displayName")


def gigography(spark, sf_dir):
    found = events.gigography(_read_events(spark, sf_dir), -4, AS_OF)
    return found.select("id", F.col("start.date").alias("start_date"))


def gigography_by_mbid(spark, sf_dir):
    band = hashlib.md5(b"NATION_3").hexdigest()
    found = events.gigography_by_mbid(_read_events(spark, sf_dir), band, AS_OF)
    return found.select("id", F.col("start.date").alias("start_date"))


def _read_setlists(spark, sf_dir):
    return pages.setlist_pages(tables.setlist_bodies(spark, sf_dir))[0]


def first_setlists(spark, sf_dir):
    first = events.first_setlists(_read_setlists(spark, sf_dir))
    flat = events.flatten(first, events.SETLIST_MODEL, "event_id")
    return flat.select(
        "event_id",
        "id",
        "display_name",
        F.col("artist.display_name").alias("artist"),
        F.size("artist.identifiers").cast("long").alias("n_identifiers"),
        F.size("setlist_items").cast("long").alias("n_songs"),
        F.get("setlist_items", F.lit(0))["title"].alias("opener"),
    )


def setlists_for(spark, sf_dir):
    found = events.setlists_for(_read_setlists(spark, sf_dir), 3)
    return found.select("event_id", "id", F.col("artist.displayName").alias("artist"))


def first_setlist(spark, sf_dir):
    found = events.first_setlist(_read_setlists(spark, sf_dir), 3)
    return found.select("event_id", "id", F.col("artist.displayName").alias("artist"))


def setlist_songs(spark, sf_dir):
    songs = pages.setlist_items(_read_setlists(spark, sf_dir))
    return songs.select(
        "event_id", "id", F.col("position").cast("long").alias("position"), "title", "encore"
    )


# Streams


def _table_feeds(spark, sf_dir):
    """The given tables as feeds whose records arrive on their own dates."""
    concerts = tables.concerts(spark, sf_dir, tables.table_stream(spark, sf_dir, "orders"))
    flights = tables.arrivals(spark, sf_dir, tables.table_stream(spark, sf_dir, "lineitem"))
    return (
        concerts.withColumn("arrival", F.col("event_date").cast("timestamp")),
        flights.withColumn("arrival", F.col("flight_date").cast("timestamp")).withColumnRenamed(
            "cents", "price"
        ),
    )


def _run_matching(spark, matches, base):
    """Stage one, then its table as a stream."""
    schema = matches.schema
    run.run_once(stream_join.write_matches(matches, f"{base}/matches"), f"{base}/checkpoints/matches")
    return spark.readStream.schema(schema).parquet(f"{base}/matches")


def stream_event_fare_avg(spark, sf_dir):
    """Both stages, and the documents they leave: the last one of each key is its average."""
    base = new_path(spark, "stream-avg")
    totals = stream_join.join_totals(
        *_table_feeds(spark, sf_dir), interval=STREAM_INTERVAL, delay=STREAM_DELAY
    )
    averaged = state.running_avg(_run_matching(spark, totals, base), CENTS)
    run.run_once(sinks.write_documents(averaged, f"{base}/documents"), f"{base}/checkpoints/averages")
    documents = spark.read.schema(
        "event_city string, event_date string, avg_price double, batch bigint"
    ).json(f"{base}/documents")
    return documents.groupBy("event_city", "event_date").agg(
        F.max_by("avg_price", "batch").alias("avg_price")
    )


def stream_running_avg_per_record(spark, sf_dir):
    """Stage two record by record, in which a fare carries the number of its concerts: the last row
    of each key is its average."""
    base = new_path(spark, "stream-record")
    matches = stream_join.join_feeds(
        *_table_feeds(spark, sf_dir), interval=STREAM_INTERVAL, delay=STREAM_DELAY
    ).select(*state.KEY, "price", "weight")
    pairs = _run_matching(spark, matches, base)
    each = averages.write_each_average(pairs, f"{base}/sums", sinks.batches_to(f"{base}/each"), CENTS)
    run.run_once(each, f"{base}/checkpoints/each")
    rows = spark.read.schema(state.AVERAGES).parquet(f"{base}/each")
    last = rows.groupBy(*state.KEY).agg(
        F.max_by("avg_price", "n").alias("avg_price"),
        F.max("n").alias("n"),
    )
    return _text_dates(last)


def stream_average_fares_latest(spark, sf_dir):
    """The average with each concert once and each fare at its latest price, from feeds that are read
    as they grow: the changes come after a restart, and take the prices back that they replace."""
    base = new_path(spark, "stream-latest")
    concerts = sinks.concert_snapshot(tables.concerts(spark, sf_dir))
    old, new, changes = _feed_snapshots(spark, sf_dir)
    second = timedelta(seconds=1)
    for snapshots in ([(new, 300), (old, 100)], [(changes, 0)]):
        sinks.write_feed(concerts, f"{base}/concerts", SNAPSHOT_TIME - snapshots[0][1] * second)
        for fares_sent, ago in snapshots:
            sinks.write_feed(fares_sent, f"{base}/fares", SNAPSHOT_TIME - ago * second)
        both = latest.feeds_as_one(
            parse.accepted(feeds.read_concerts_stream(spark, f"{base}/concerts")),
            parse.accepted(feeds.read_flights_stream(spark, f"{base}/fares")),
        )
        writer = latest.write_latest_averages(both, f"{base}/state", sinks.batches_to(f"{base}/averages"))
        run.run_once(writer, f"{base}/checkpoint")
    rows = spark.read.schema("event_city string, event_date date, avg_price double, n bigint, batch bigint").parquet(f"{base}/averages")
    last = rows.groupBy("event_city", "event_date").agg(F.max_by(F.struct("avg_price", "n"), "batch").alias("last"))
    return _text_dates(last.select("event_city", "event_date", "last.*"))


def documents_current(spark, sf_dir):
    """The documents of several batches, merged along the way into one for each city and date."""
    base = new_path(spark, "stream-current")
    totals = stream_join.join_totals(*_table_feeds(spark, sf_dir), interval=STREAM_INTERVAL, delay=STREAM_DELAY)
    schema = totals.schema
    run.run_once(stream_join.write_matches(totals, f"{base}/matches"), f"{base}/checkpoints/matches")
    # A batch costs a task for each partition of the state, and every other one merges all documents. So
    # the files, of which there is one for each partition, are shared out over a fixed number of batches.
    n_files = len(spark.read.schema(schema).parquet(f"{base}/matches").inputFiles())
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max(3, math.ceil(n_files / DOCUMENT_BATCHES)))
    sent = sinks.sent_once(f"{base}/ledger", sinks.batches_to(f"{base}/documents", "json"))

    def send(documents, batch_id):
        sent(documents, batch_id)
        if batch_id % 2:
            sinks.compact_documents(spark, f"{base}/documents")

    averaged = state.running_avg(reader.parquet(f"{base}/matches"), CENTS)
    run.run_once(sinks.write_documents(averaged, "", write=send), f"{base}/checkpoints/averages")
    return sinks.current_documents(spark, f"{base}/documents").drop("batch")


def late_rows(spark, sf_dir):
    """Feeds that arrive in three shares, each on its own dates: what the join drops as too late."""
    base = new_path(spark, "stream-late")
    listed = tables.concerts(spark, sf_dir).select(
        F.col("concert_id").alias("id"), F.lit(0).cast("bigint").alias("line"), "event_city", "event_date",
        F.col("event_date").cast("timestamp").alias("arrival"), (F.col("concert_id") % 3).alias("share"),
    )
    priced = tables.arrivals(spark, sf_dir, also=("l_orderkey", "l_linenumber")).select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").cast("bigint").alias("line"), "end_city", "flight_date",
        F.col("cents").alias("price"), F.col("flight_date").cast("timestamp").alias("arrival"), ((F.col("l_linenumber") - 1) % 3).alias("share"),
    )
    both = {"concerts": keep(listed, "late-concerts"), "fares": keep(priced, "late-fares")}
    schemas = {name: rows.drop("share").schema for name, rows in both.items()}
    for share in range(3):
        for name, rows in both.items():
            rows.where(F.col("share") == share).drop("share").write.mode("append").parquet(f"{base}/{name}")
        streams = [spark.readStream.schema(schemas[name]).parquet(f"{base}/{name}") for name in both]
        totals = stream_join.join_totals(*streams, interval=STREAM_INTERVAL, delay="400 days")
        with late.one_watermark(spark):
            run.run_once(stream_join.write_matches(totals, f"{base}/matches"), f"{base}/checkpoint")
    dropped = [
        late.late_records(spark.read.schema(schemas[name]).parquet(f"{base}/{name}"), f"{base}/checkpoint", STREAM_INTERVAL).select(
            F.lit(name).alias("feed"), "id", "line", F.col("arrival").cast("date").cast("string").alias("arrival")
        )
        for name in both
    ]
    return dropped[0].unionByName(dropped[1])


def stream_clock(spark, sf_dir):
    """Fares taken in by the processing-time clock, by a query that is stopped and started again."""
    base = new_path(spark, "stream-clock")
    arrivals = tables.arrivals(spark, sf_dir, tables.table_stream(spark, sf_dir, "lineitem"))
    for _ in range(2):
        writer = arrivals.writeStream.format("parquet").option("path", f"{base}/fares")
        query = run.start(writer, f"{base}/checkpoint", interval="1 second")
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    read = spark.read.schema(arrivals.schema).parquet(f"{base}/fares")
    return read.groupBy("end_city").agg(F.count("*").alias("n"), F.sum("cents").alias("total"))


def feed_stamps(spark, sf_dir):
    """The compact stamps of the times of events, and how many events share each."""
    times = tables.table(spark, sf_dir, "events").select(compact_stamp(F.col("ts").cast("timestamp")).alias("stamp"))
    return times.groupBy("stamp").agg(F.count("*").alias("n"))


def fare_validity(spark, sf_dir):
    """How long each fare was valid, over a series of four snapshots."""
    old, new = _snapshots(spark, sf_dir)
    series = [s.withColumn("snapshot", F.lit(k)) for k, s in ((10, old), (20, new), (30, new), (40, old))]
    return _text_dates(fares.validity(reduce(DataFrame.unionByName, series), "snapshot", "cents"))


def page_gaps(spark, sf_dir):
    """Listing pages of each city, of which some did not come: what is missing."""
    path = new_path(spark, "paged")
    came = tables.paged_bodies(spark, sf_dir).where("page % 7 <> 3 and page % 11 not in (5, 6)")
    came.select("city", "body").write.json(path)
    read = spark.read.schema("city string, body string").json(path)
    return pages.missing_pages(pages.page_numbers(read), "city")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        event_fare_avg,
        city_totals,
        event_flights_window,
        concert_flights,
        to_documents,
        running_avg,
        running_avg_split,
        number_rows,
        positive_fares,
        routes,
        served_routes,
        date_spine,
        unpivot_fares,
        decode_ids,
        route_range,
        rescale_fares,
        over_cap,
        cap_fares,
        fare_diff,
        fare_changes,
        latest_fare,
        city_list,
        city_in,
        concert_csv,
        parse_quarantine,
        fare_feed,
        snapshot_and_changes,
        average_fares,
        average_fares_latest,
        stream_feeds,
        event_pages,
        page_rejects,
        page_items,
        unconverted,
        event_search,
        concert_feed,
        active_events,
        by_mbid,
        gigography,
        gigography_by_mbid,
        setlists_for,
        first_setlist,
        first_setlists,
        setlist_songs,
        stream_event_fare_avg,
        stream_running_avg_per_record,
        stream_average_fares_latest,
        documents_current,
        late_rows,
        stream_clock,
        feed_stamps,
        fare_validity,
        page_gaps,
    )
}
