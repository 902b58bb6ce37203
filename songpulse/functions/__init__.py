"""Column -> Column scalar functions (all JVM-side, no UDFs)."""

from songpulse.functions.text import (
    EXTRACTION_PATTERNS,
    extract_song_artist,
    lookup_key,
    strip,
    tokens,
)
from songpulse.functions.time import (
    epoch_ms_from_ntz,
    epoch_seconds,
    epoch_seconds_from_ntz,
    hour_label,
    hour_start,
)

__all__ = [
    "EXTRACTION_PATTERNS",
    "epoch_ms_from_ntz",
    "epoch_seconds",
    "epoch_seconds_from_ntz",
    "extract_song_artist",
    "hour_label",
    "hour_start",
    "lookup_key",
    "strip",
    "tokens",
]
