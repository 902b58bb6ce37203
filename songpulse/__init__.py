"""songpulse: music-mention analytics for short posts, expressed as Spark DataFrame plans.

Posts are parsed from line-delimited JSON, cleaned and split into (song, artist) with native
column expressions, enriched with genre from a catalogue table by joins, and summarised as
hourly genre counts, headline totals, top-k rankings and genre time series.
"""

__version__ = "0.1.0"
