"""Result sinks: JSON lines, CSV summary, hour/day-partitioned records, retry lists."""
