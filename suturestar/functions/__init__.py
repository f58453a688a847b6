"""Column-level building blocks: measures, date/time keys, delimited lists."""
