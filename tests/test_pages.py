import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from eventfares.operators import events
from eventfares.plans.concert_feed import concerts_from
from eventfares.sources import pages

from .conftest import day


def event(id, date="2018-11-16", city="Dublin, Ireland", artists=("Artist A",), **more):
    return {
        "id": id,
        "status": "ok",
        "type": "concert",
        "displayName": f"Event {id}",
        "popularity": 0.000123,
        "location": {"city": city, "lat": 53.3, "lng": -6.2},
        "start": {"date": date, "time": None, "datetime": None},
        "performance": [
            {
                "id": 100 + i,
                "displayName": a,
                "billing": "headline",
                "billingIndex": i + 1,
                "artist": {
                    "displayName": a,
                    "uri": f"uri/{a}",
                    "identifier": [{"href": "h", "mbid": f"mbid-{a}"}],
                },
            }
            for i, a in enumerate(artists)
        ],
        **more,
    }


def page(*items, enclosure="event"):
    return json.dumps({"resultsPage": {"results": {enclosure: list(items)}}})


@pytest.fixture
def read(spark):
    def make(*bodies):
        return pages.event_pages(spark.createDataFrame([(b,) for b in bodies], "body string"))

    return make


def ids(df):
    return sorted(r.id for r in df.collect())


def test_pages_become_one_row_per_event(read):
    good, bad = read(page(event(1), event(2)), page(event(3)), page())
    assert ids(good) == [1, 2, 3] and bad.count() == 0


def test_an_unfit_event_leaves_the_rest_of_its_page(read):
    odd = event(2, venue={"id": "x9"})
    good, bad = read(page(event(1), odd, event(3), "text", None))
    assert ids(good) == [1, 3]
    set_aside = bad.collect()
    assert {r.reason for r in set_aside} == {"bad event"} and len(set_aside) == 3
    assert [json.loads(r.body)["id"] for r in set_aside if (r.body or "")[:1] == "{"] == [2]


def test_an_unfit_setlist_leaves_the_rest_of_its_page(spark):
    sets = [{"id": i, "setlistItem": [{"name": "a", "encore": e}]} for i, e in ((1, 0), (2, True), (3, 1))]
    good, bad = pages.setlist_pages(spark.createDataFrame([(page(*sets, enclosure="setlist"),)], "body string"))
    assert ids(good) == [1, 3] and [r.reason for r in bad.collect()] == ["bad setlist"]


def test_values_that_do_not_convert_are_named(read):
    start = {"date": "soon", "time": "8pm", "datetime": "Friday night"}
    good, _ = read(page(event(1, start=start), event(2)))
    flat = events.flatten(good, events.EVENT_MODEL, failed="failed").orderBy("id").collect()
    assert [sorted(r.failed) for r in flat] == [["event_start.date", "event_start.datetime", "event_start.time"], []]


def test_null_ids_come_last(spark):
    sets = spark.createDataFrame([(7, None, "x"), (7, 5, "y"), (8, None, "z")], "event_id bigint, id bigint, displayName string")
    assert events.first_setlist(sets, 7).first().id == 5
    assert sorted((r.event_id, r.id) for r in events.first_setlists(sets).collect()) == [(7, 5), (8, None)]


def test_past_events_by_musicbrainz_id(read):
    good, _ = read(page(event(1), event(2, date="2019-01-01"), event(3, artists=("B",))))
    assert ids(events.gigography_by_mbid(good, "mbid-Artist A", "2018-12-01")) == [1]


def test_bad_pages_are_rejected_with_their_reason(read):
    wrong = json.dumps({"resultsPage": {"status": "error"}})
    other = page({"id": 1}, enclosure="setlist")
    good, bad = read("{not json", "", wrong, other, page(event(1)))
    assert ids(good) == [1]
    assert sorted((r.reason, r.body) for r in bad.collect()) == sorted(
        [("malformed", "{not json"), ("malformed", ""), ("no event list", wrong), ("no event list", other)]
    )


def test_pretty_printed_files_and_lines(spark, tmp_path):
    whole, by_line = tmp_path / "whole", tmp_path / "lines"
    whole.mkdir(), by_line.mkdir()
    (whole / "1.json").write_text(json.dumps(json.loads(page(event(1), event(2))), indent=2))
    (by_line / "1.json").write_text(page(event(1)) + "\n" + page(event(2)) + "\n")
    for path, whole_files in ((whole, True), (by_line, False)):
        good, bad = pages.read_event_pages(spark, str(path), whole_files)
        assert ids(good) == [1, 2] and bad.count() == 0


def test_flatten_types_and_defaults(read):
    good, _ = read(
        page(
            event(
                1,
                series={"displayName": "S"},
                venue={"id": 5, "displayName": "V", "metroArea": {"country": {"displayName": "Ireland"}}},
                start={"date": "2018-11-16", "time": "20:30:00", "datetime": "2018-11-16T20:30:00+0100"},
                end={"date": "2018-02-30", "time": "25:00:00", "datetime": "soon"},
            ),
            {"id": 2},
        )
    )
    flat = events.flatten(good, events.EVENT_MODEL)
    one, two = flat.orderBy("id").collect()
    assert one.event_type == "concert" and one.series.display_name == "S"
    assert one.venue.metro_area.country == "Ireland"
    assert str(one.popularity) == "0.000123000000000000"
    assert one.event_start.date == day("2018-11-16") and one.event_start.time == "20:30:00"
    assert (one.event_end.date, one.event_end.time, one.event_end.datetime) == (None, None, None)
    assert one.artists[0].identifiers[0].musicbrainz_id == "mbid-Artist A"
    assert one.artists[0].uri == "uri/Artist A" and one.artists[0].billing_index == 1
    assert two.artists == [] and two.venue is None and two.event_start is None
    moment = flat.select(F.date_format("event_start.datetime", "yyyy-MM-dd HH:mm")).first()[0]
    assert moment == "2018-11-16 19:30"


def test_search_repeats_an_event_for_every_list_entry(read):
    good, _ = read(
        page(
            event(1, artists=("A", "B", "A")),
            event(2, artists=("B",)),
            event(3, date="2019-11-02", artists=("A",)),
            event(4, date="2018-08-01", artists=("A",)),
            event(5, date="2019-11-01", artists=("A",)),
            event(6, artists=()),
        )
    )
    found = events.search(good, ["A", "B", "A"], "2018-08-01", "2019-11-01")
    assert sorted((r.list_position, r.id) for r in found.collect()) == [
        (0, 1), (0, 4), (0, 5), (1, 1), (1, 2), (2, 1), (2, 4), (2, 5),
    ]


def test_city_list_as_values_and_as_table(read, spark):
    good, _ = read(page(event(1), event(2, city="Cork, Ireland"), event(3, city=None)))
    city = F.col("location.city")
    table = spark.createDataFrame([("Dublin, Ireland",), ("Dublin, Ireland",)], "city string")
    assert ids(events.in_cities(good, ["Dublin, Ireland"], city)) == [1]
    assert ids(events.in_cities(good, table, city)) == [1]


def test_lookups(read):
    good, _ = read(
        page(
            event(1, artists=("A", "B")),
            event(2, status="cancelled", artists=("B",)),
            event(3, date="2018-01-01", status=None, artists=("A",)),
            {"id": 4},
        )
    )
    assert ids(events.by_mbid(good, "mbid-B")) == [1, 2]
    assert ids(events.gigography(good, 100, "2018-11-16")) == [3]
    assert ids(events.gigography(good, 101, "2018-11-17")) == [1]
    assert ids(events.active(good)) == [1]


def test_to_concerts_takes_the_first_performer(read):
    good, _ = read(page(event(1, artists=("A", "B")), event(2, artists=())))
    rows = events.to_concerts(good, "id").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        ("A", day("2018-11-16"), "Dublin", 1),
        (None, day("2018-11-16"), "Dublin", 2),
    ]


def test_concert_feed_numbers_by_list_entry_then_date(read):
    good, _ = read(
        page(
            event(10, date="2019-01-02", artists=("B",)),
            event(11, date="2019-01-01", artists=("B",)),
            event(12, date="2019-05-01", artists=("A",)),
            event(13, city="Cork, Ireland", artists=("A",)),
        )
    )
    feed = concerts_from(good, ["A", "B"]).orderBy("concert_id").collect()
    assert [tuple(r) for r in feed] == [
        (0, "A", day("2019-05-01"), "Dublin"),
        (1, "B", day("2019-01-01"), "Dublin"),
        (2, "B", day("2019-01-02"), "Dublin"),
    ]


def test_setlists_are_partitioned_by_their_event(spark, tmp_path):
    def setlist(id, *songs):
        return {
            "id": id,
            "displayName": f"Set {id}",
            "artist": {"id": 1, "displayName": "A"},
            "setlistItem": [{"name": n, "encore": e} for n, e in songs],
        }

    for event_id, sets in ((7, [setlist(3, ("x", 0)), setlist(2, ("y", 0), ("z", 1))]), (8, [])):
        folder = tmp_path / f"event_id={event_id}"
        folder.mkdir()
        (folder / "page.json").write_text(page(*sets, enclosure="setlist"))
    setlists, bad = pages.read_setlist_pages(spark, str(tmp_path))
    assert bad.count() == 0
    assert ids(events.setlists_for(setlists, 7)) == [2, 3]
    assert ids(events.first_setlist(setlists, 7)) == [2]
    assert events.first_setlist(setlists, 8).count() == 0
    assert [(r.event_id, r.id) for r in events.first_setlists(setlists).collect()] == [(7, 2)]
    songs = pages.setlist_items(events.first_setlist(setlists, 7)).orderBy("position").collect()
    assert [(r.title, r.encore) for r in songs] == [("y", False), ("z", True)]
    flat = events.flatten(setlists, events.SETLIST_MODEL, "event_id").where("id = 2").first()
    assert [(i.title, i.encore) for i in flat.setlist_items] == [("y", False), ("z", True)]
    assert flat.artist.identifiers == []
