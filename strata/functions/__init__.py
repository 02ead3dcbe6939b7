"""Column-level helpers: names, time, numbers, bins."""
