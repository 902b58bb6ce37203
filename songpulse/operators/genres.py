"""Genre dictionary: last-entry-wins de-duplication, and name -> id lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from songpulse.functions import strip


def normalise_genre(c: Column | str) -> Column:
    return F.lower(strip(c))


def dedupe_last(raw: DataFrame, key: str = "name", value: str = "genre_id", order: str = "ordinal") -> DataFrame:
    """Keep, per key, the value of the highest ordinal (a grouped aggregate; no sort)."""
    return raw.groupBy(key).agg(F.max_by(value, order).alias(value))


def genre_dim(entries: DataFrame) -> DataFrame:
    """(name, genre_id) with unique normalised names, from a dictionary table (ordinal, name,
    genre_id) that may repeat names: the last entry of a name wins."""
    return dedupe_last(entries.withColumn("name", normalise_genre("name")))


def _requests(requests: DataFrame, col: str) -> DataFrame:
    # Empty and NULL requests are "no request", not unknown names.
    return requests.withColumn("name", normalise_genre(col)).where(F.col("name") != "")


def lookup_genres(requests: DataFrame, dim: DataFrame, col: str = "request") -> DataFrame:
    """Requests with their genre id; unknown names drop out (see ``unknown_genres``)."""
    return _requests(requests, col).join(dim, "name", "inner")


def unknown_genres(requests: DataFrame, dim: DataFrame, col: str = "request") -> DataFrame:
    """Requests whose normalised name is not in the dictionary."""
    return _requests(requests, col).join(dim, "name", "left_anti")


def top_10_songs(requests: DataFrame, dim: DataFrame, feed_rows: DataFrame, col: str = "request") -> DataFrame:
    """(name, genre_id, pos, label, n_parts, song, artist): the feed entries of each requested genre.

    A request is trimmed, lower-cased and looked up in the dictionary ``dim``; an empty, NULL or
    unknown genre has no rows. ``feed_rows`` are entries by genre id, as ``read_feed`` gives them.
    """
    names = lookup_genres(requests, dim, col).select("name", "genre_id").distinct()
    return names.join(feed_rows, "genre_id")
