"""Places named in free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.functions.regex import first_match, matches
from snapdemand.functions.text import lookup


def canonical_place(
    location: Column,
    places: dict[str, str] = model.PLACES,
    country: str = model.COUNTRY_PATTERN,
    bucket: str = model.COUNTRY_BUCKET,
) -> Column:
    """The standard name of the place that stands first in ``location``; ``bucket`` when only the country is named.

    At one position the name listed first in ``places`` wins, so list longer names before their prefixes.
    """
    named = lookup(places, first_match(F.lower(location), "|".join(places)))
    return F.coalesce(named, F.when(matches(location, country), bucket))


def in_region(location: Column, title: Column, pattern: str = model.KEEP_PATTERN) -> Column:
    """Does the location match; the title is asked only when there is no location. Null counts as ''."""
    place = F.coalesce(F.nullif(location, F.lit("")), title, F.lit(""))
    return matches(place, pattern)


def many_places(location: Column, pattern: str = model.MANY_PLACES_PATTERN) -> Column:
    """Is the whole text of the form "N Locations"?"""
    return F.coalesce(matches(location, pattern), F.lit(False))
