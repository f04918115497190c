"""Plan-level helpers: size-checked broadcast, student partitioning, staged job."""
