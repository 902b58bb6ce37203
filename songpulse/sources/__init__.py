"""Sources and sinks: driver tables, derived fixtures, post lines, feed documents, text sinks."""
