"""Declared schemas of the feeds and API pages. Nothing is inferred."""

from __future__ import annotations

# Feed records in file order, and the fields of the listing pages.
CONCERTS = "concert_id bigint, artist string, event_date date, event_city string"
FLIGHTS = "start_city string, end_city string, flight_date date, price double"
CORRUPT = "_corrupt_record"

_DATE = "struct<date:string, time:string, datetime:string>"
_IDENTIFIERS = "array<struct<href:string, mbid:string>>"

EVENT = f"""struct<
  id:bigint, status:string, type:string, displayName:string,
  popularity:decimal(38,18), uri:string,
  series:struct<displayName:string>,
  venue:struct<
    id:bigint, displayName:string, lat:double, lng:double, uri:string,
    metroArea:struct<id:bigint, displayName:string, country:struct<displayName:string>>>,
  location:struct<city:string, lat:double, lng:double>,
  start:{_DATE},
  `end`:{_DATE},
  performance:array<struct<
    id:bigint, displayName:string, billing:string, billingIndex:int,
    artist:struct<displayName:string, uri:string, identifier:{_IDENTIFIERS}>>>>"""

SETLIST = f"""struct<
  id:bigint, displayName:string,
  artist:struct<id:bigint, displayName:string, uri:string, identifiers:{_IDENTIFIERS}>,
  setlistItem:array<struct<name:string, encore:int>>>"""


def page(enclosure: str, item: str) -> str:
    """Schema of an API response whose result list is called `enclosure`."""
    return f"resultsPage struct<results:struct<{enclosure}:array<{item}>>>"
