"""Per-genre "top songs" feed documents: build them from the catalogue, land them as JSON
files partitioned by genre id, and read them back as (genre_id, pos, song, artist) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from songpulse import schemas
from songpulse.operators.ranking import top_tracks_by_popularity


def build_feed_docs(cat: DataFrame, dim: DataFrame, k: int = 10) -> DataFrame:
    """One JSON document per genre id: its ``k`` most popular tracks as ``song - artist``
    labels, then one label without a separator and one with two."""
    top = top_tracks_by_popularity(cat, k)
    label = F.concat_ws(" - ", "song", "artist")
    at = lambda pos, text: F.struct(pos.cast("int").alias("pos"), text.alias("label"))
    # The extra labels are made from the first track's own row: one pass over the catalogue.
    first = F.array(
        at(F.lit(0), label), at(F.lit(k), F.col("song")), at(F.lit(k + 1), F.concat_ws(" - ", label, F.lit("live")))
    )
    each = F.when(F.col("rank") == 1, first).otherwise(F.array(at(F.col("rank") - 1, label)))
    # At most k + 2 entries per genre, so collecting them per genre is bounded.
    entries = top.select("genre", F.explode(each).alias("x")).groupBy("genre").agg(
        F.sort_array(F.collect_list("x")).alias("e")
    )
    docs = entries.join(dim, F.lower(F.col("genre")) == F.col("name"))
    doc = F.to_json(
        F.struct(
            F.struct(
                F.transform("e", lambda x: F.struct(F.struct(x["label"].alias("label")).alias("title")))
                .alias("entry")
            ).alias("feed")
        )
    )
    return docs.select("genre_id", doc.alias("value"))


def write_feed_docs(docs: DataFrame, path: str) -> None:
    docs.write.mode("errorifexists").partitionBy("genre_id").text(path)


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """(genre_id, pos, label, n_parts, song, artist); a label is split on the literal
    ``' - '`` and may give one part (artist NULL) or more than two."""
    raw = spark.read.option("basePath", path).text(path)
    doc = raw.select(F.col("genre_id").cast("bigint"), F.from_json("value", schemas.FEED).alias("d"))
    ex = doc.select("genre_id", F.posexplode("d.feed.entry").alias("pos", "entry"))
    parts = F.split(F.col("entry.title.label"), " - ", -1)
    return ex.select(
        "genre_id",
        F.col("pos").cast("int"),
        F.col("entry.title.label").alias("label"),
        F.size(parts).cast("int").alias("n_parts"),
        F.try_element_at(parts, F.lit(1)).alias("song"),
        F.try_element_at(parts, F.lit(2)).alias("artist"),
    )
