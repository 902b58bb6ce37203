"""Catalogue search as joins.

A request (artist, song) resolves, like a catalogue search service would, to:

* both given: the best track whose ``lower(artist + ' ' + song)`` equals the request text;
  failing that, the artist's best track with the artist's main genre (fallback);
* artist only: the artist's best track, with that track's own genre;
* song only: the best track with that title;
* nothing, or nothing found: no result.

"Best" is highest popularity, then lowest track id; an artist's main genre is the genre of most
of its tracks, ties to the smaller name. Each lookup table is one grouped aggregate of the
catalogue (partial aggregation, no window sort), keyed by the normalised text.

Join strategy: the catalogue's measured bytes bound the lookup tables. Within the broadcast limit,
taken over all of them together, they are broadcast and the requests are never shuffled. Beyond it the distinct requests are
resolved first (a hot request collapses in the map-side aggregate) and joined back once; AQE
splits a skewed join partition. Plans without AQE (streams with state) join directly; there the requests that
hold a large share of the rows, found by an approximate count, are salted: their rows go to as many partitions
as there are salts, and only their few lookup rows are copied.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songpulse.functions import lookup_key, strip
from songpulse.plans.sizing import byte_bound, fits_broadcast
from songpulse.session import checkpoint_root

RESULT = ("artist", "song", "genre", "track_id")
#: Share of all rows from which a request is hot, and entries of the sketch that counts them.
HOT_SHARE, SKETCH_ITEMS = 1 / 64, 10_000
SALT_SEED = 17


def _best(keyed: DataFrame, key: str) -> DataFrame:
    best = F.max(
        F.struct(
            F.col("popularity"),
            (-F.col("track_id")).alias("neg_id"),
            *[F.col(c) for c in RESULT],
        )
    ).alias("_b")
    return keyed.groupBy(key).agg(best).select(
        key, *[F.col(f"_b.{c}").alias(c) for c in RESULT], F.col("_b.popularity").alias("popularity")
    )


def best_hits(cat: DataFrame) -> DataFrame:
    """(key, artist, song, genre, track_id, popularity): best track per artist+song text."""
    return _best(cat.withColumn("key", lookup_key("artist", "song")), "key")


def song_hits(cat: DataFrame) -> DataFrame:
    """(song_key, ...): best track per title text."""
    return _best(cat.withColumn("song_key", F.lower(strip("song"))), "song_key")


def artist_top(cat: DataFrame) -> DataFrame:
    """(artist_key, artist, song, genre, own_genre, track_id): the artist's best track, the artist's
    main genre and the track's own."""
    keyed = cat.withColumn("artist_key", F.lower(strip("artist")))
    per_genre = keyed.groupBy("artist_key", "genre").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(
            F.struct(
                F.col("popularity"),
                (-F.col("track_id")).alias("neg_id"),
                F.col("track_id"),
                F.col("artist"),
                F.col("song"),
                F.col("genre").alias("own_genre"),
            )
        ).alias("top"),
    )
    per_artist = per_genre.groupBy("artist_key").agg(
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("genre"))).alias("g"),
        F.max("top").alias("t"),
    )
    return per_artist.select(
        "artist_key",
        F.col("t.artist").alias("artist"),
        F.col("t.song").alias("song"),
        F.col("g.genre").alias("genre"),
        F.col("t.own_genre").alias("own_genre"),
        F.col("t.track_id").alias("track_id"),
    )


#: Strings of a lookup table's row beside its key.
NAMES = {
    "_hit": ("_hit.song", "_hit.artist", "_hit.genre"),
    "_top": ("_top.song", "_top.artist", "_top.genre", "own_genre"),
    "_song_hit": ("_song_hit.song", "_song_hit.artist", "_song_hit.genre"),
}


def _as_result(df: DataFrame, key: str, name: str, *more: str) -> DataFrame:
    return df.select(F.col(key), F.struct(*[F.col(c) for c in RESULT]).alias(name), *more)


@dataclass(frozen=True)
class CatalogIndex:
    """The lookup tables of a catalogue and a bound on their bytes. ``song_hits`` is for song-only
    requests; an index for enrichment alone has none."""

    hits: DataFrame
    tops: DataFrame
    song_hits: DataFrame | None
    n_bytes: int


def catalog_index(cat: DataFrame, materialize: bool = False, song_only: bool = True) -> CatalogIndex:
    """Lookup tables of ``cat``. With ``materialize`` each is computed once and checkpointed
    into ``spark.checkpoint.dir`` (lineage cut), for plans that re-run often, e.g. every
    micro-batch of a stream-static join."""
    tables = [_as_result(best_hits(cat), "key", "_hit"), _as_result(artist_top(cat), "artist_key", "_top", "own_genre")]
    if song_only:
        tables.append(_as_result(song_hits(cat), "song_key", "_song_hit"))
    if materialize:
        checkpoint_root(cat.sparkSession)
        tables = [t.checkpoint(eager=True) for t in tables]
        # The tables are there to be measured: far fewer rows than the catalogue's where names repeat.
        n_bytes = sum(byte_bound(t, (t.columns[0], *NAMES[t.columns[1]])) for t in tables)
    else:
        # Each table has at most a row per track: its names, and a key made of them.
        n_bytes = len(tables) * byte_bound(cat, ("song", "artist", "song", "artist", "genre", "genre"))
    return CatalogIndex(tables[0], tables[1], tables[2] if song_only else None, n_bytes)


@dataclass(frozen=True)
class HotRequests:
    """Keys of the requests (artist and song) and artists that hold a large share of the rows."""

    pairs: tuple[str, ...] = ()
    artists: tuple[str, ...] = ()


def hot_requests(requests: DataFrame, artist: str = "artist", song: str = "song", share: float = HOT_SHARE) -> HotRequests:
    """The requests that make up at least ``share`` of the rows, by one approximate count (a frequent-items
    sketch of fixed size per task). At most 1 / share keys come back. A missed or a wrong key costs time, no row."""
    a, s = F.coalesce(strip(artist), F.lit("")), F.coalesce(strip(song), F.lit(""))
    both = requests.select(F.lower(F.concat(a, F.lit(" "), s)).alias("pair"), F.lower(a).alias("artist")).where((a != "") & (s != ""))
    most = int(1 / share)
    top = [F.expr(f"approx_top_k({c}, {most}, {SKETCH_ITEMS})").alias(c) for c in ("pair", "artist")]
    found = both.agg(F.count(F.lit(1)).alias("n"), *top).first()
    keys = lambda items: tuple(i["item"] for i in items or () if i["item"] and i["count"] >= share * found["n"])
    return HotRequests(keys(found["pair"]), keys(found["artist"]))


def _join_lookup(x: DataFrame, table: DataFrame, key: str, table_key: str, hot: tuple[str, ...], salts: int) -> DataFrame:
    """Left join of requests with a lookup table; hot keys, and rows without a key, are spread over ``salts``."""
    if not hot:
        return x.join(table, x[key] == F.col(table_key), "left")
    spread = F.col(key).isin(*hot) | F.col(key).isNull()
    x = x.withColumn("_salt", F.when(spread, F.floor(F.rand(SALT_SEED) * salts)).otherwise(F.lit(0)).cast("int"))
    copies = F.when(F.col(table_key).isin(*hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    table = table.withColumn("_table_salt", F.explode(copies))
    both = (x[key] == F.col(table_key)) & (F.col("_salt") == F.col("_table_salt"))
    return x.join(table, both, "left").drop("_salt", "_table_salt")


def _attach(
    req: DataFrame, idx: CatalogIndex, broadcast: bool, with_song_only: bool, hot: HotRequests = HotRequests()
) -> DataFrame:
    """Add ``_res`` (struct of RESULT or NULL) to a frame with stripped ``_a``, ``_s``."""
    salts = int(req.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a, s = F.col("_a"), F.col("_s")
    both = (a != "") & (s != "")
    keys = [
        F.when(both, F.lower(F.concat(a, F.lit(" "), s))).alias("_pk"),
        F.when((a != "") if with_song_only else both, F.lower(a)).alias("_ak"),
    ]
    if with_song_only:
        keys.append(F.when((a == "") & (s != ""), F.lower(s)).alias("_sk"))
    x = req.select("*", *keys)
    hint = F.broadcast if broadcast else (lambda d: d)
    x = _join_lookup(x, hint(idx.hits), "_pk", "key", () if broadcast else hot.pairs, salts)
    picks = [F.col("_hit")]
    if with_song_only:
        x = x.join(hint(idx.song_hits), x["_sk"] == F.col("song_key"), "left")
        picks.append(F.col("_song_hit"))
    x = _join_lookup(x, hint(idx.tops), "_ak", "artist_key", () if broadcast else hot.artists, salts)
    top, genre = F.col("_top"), F.when(s != "", F.col("_top.genre")).otherwise(F.col("own_genre"))
    picks.append(F.when(top.isNotNull(), F.struct(top["artist"], top["song"], genre.alias("genre"), top["track_id"])))
    return x.select("*", F.coalesce(*picks).alias("_res"))


def _resolve(
    requests: DataFrame,
    cat: DataFrame | CatalogIndex,
    artist: str,
    song: str,
    with_song_only: bool,
    strategy: str,
    how: str = "left",
    hot: HotRequests = HotRequests(),
) -> DataFrame:
    idx = cat if isinstance(cat, CatalogIndex) else catalog_index(cat, song_only=with_song_only)
    if not with_song_only and how == "inner":
        # Enrichment: requests without both names cannot resolve. Over a stored table this filter
        # reaches the parquet reader; no NULL key reaches a shuffle.
        requests = requests.where((F.col(artist) != "") & (F.col(song) != ""))
    req = requests.select(
        "*",
        F.coalesce(strip(artist), F.lit("")).alias("_a"),
        F.coalesce(strip(song), F.lit("")).alias("_s"),
    )
    if not with_song_only and how == "inner":
        req = req.where((F.col("_a") != "") & (F.col("_s") != ""))
    if strategy == "auto":
        strategy = "broadcast" if fits_broadcast(req.sparkSession, idx.n_bytes) else "distinct"
    if strategy in ("broadcast", "direct"):
        out = _attach(req, idx, strategy == "broadcast", with_song_only, hot)
        return out.select(*requests.columns, "_res")
    if strategy != "distinct":
        raise ValueError(f"unknown strategy {strategy!r}")
    keys = req.select("_a", "_s").distinct()
    resolved = _attach(keys, idx, False, with_song_only).select("_a", "_s", "_res")
    if how == "inner":
        resolved = resolved.where(F.col("_res").isNotNull())
    return req.join(resolved, ["_a", "_s"], how).select(*requests.columns, "_res")


def lookup(
    requests: DataFrame,
    cat: DataFrame | CatalogIndex,
    artist: str = "artist",
    song: str = "song",
    keep_unmatched: bool = False,
    strategy: str = "auto",
) -> DataFrame:
    """Requests plus resolved (artist, song, genre, track_id) under ``res_*`` names.
    Unresolved requests are dropped unless ``keep_unmatched`` (then the results are NULL)."""
    how = "left" if keep_unmatched else "inner"
    out = _resolve(requests, cat, artist, song, True, strategy, how)
    if not keep_unmatched:
        out = out.where(F.col("_res").isNotNull())
    return out.select(
        *requests.columns, *[F.col(f"_res.{c}").alias(f"res_{c}") for c in RESULT]
    )


def enrich(
    cleaned: DataFrame,
    cat: DataFrame | CatalogIndex,
    keep: tuple[str, ...] = (),
    strategy: str = "auto",
    hot: HotRequests = HotRequests(),
) -> DataFrame:
    """Enriched table (raw_tweet, processed_tweet, artist, song, genre, tweet_time[, keep])
    from cleaned rows. Rows without both song and artist, and rows the catalogue cannot
    resolve to a genre, are dropped (so a prior ``complete_tweets`` filter is optional). ``hot``
    spreads those requests over salts on the ``direct`` strategy."""
    base = cleaned.select("raw_tweet", "processed_tweet", "artist", "song", "tweet_time", *keep)
    out = _resolve(base, cat, "artist", "song", False, strategy, "inner", hot).where(F.col("_res.genre").isNotNull())
    return out.select(
        "raw_tweet",
        "processed_tweet",
        F.col("_res.artist").alias("artist"),
        F.col("_res.song").alias("song"),
        F.col("_res.genre").alias("genre"),
        "tweet_time",
        *keep,
    )
