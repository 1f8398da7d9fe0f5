"""Column-level helpers: keys, times, guards and statistics."""
