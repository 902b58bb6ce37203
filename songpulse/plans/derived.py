"""The standard chain over the driver tables: catalogue, posts, cleaned, complete, enriched.

Each attribute is a lazy DataFrame plan; nothing runs until an action.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from songpulse.operators.catalog import enrich
from songpulse.operators.clean import clean_tweets, complete_tweets
from songpulse.sources import fixtures
from songpulse.sources.tables import Tables


class Derived:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = Tables(spark, sf_dir)

    @cached_property
    def catalog(self) -> DataFrame:
        return fixtures.catalog(self.t.part)

    @cached_property
    def tweets(self) -> DataFrame:
        """(event_id, user_id, ts, raw_tweet, tweet_time)."""
        return fixtures.tweets(self.t.events, self.t.part)

    @cached_property
    def cleaned_ids(self) -> DataFrame:
        """Cleaned rows carrying event_id and user_id along."""
        return clean_tweets(self.tweets, keep=("event_id", "user_id"))

    @cached_property
    def cleaned(self) -> DataFrame:
        return self.cleaned_ids.select("raw_tweet", "processed_tweet", "song", "artist", "tweet_time")

    @cached_property
    def complete(self) -> DataFrame:
        return complete_tweets(self.cleaned)

    @cached_property
    def enriched_users(self) -> DataFrame:
        return enrich(self.cleaned_ids, self.catalog, keep=("user_id",))

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich(self.cleaned, self.catalog)
