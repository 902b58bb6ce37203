"""Plan-level helpers (sizing decisions) and the registry of named queries."""
