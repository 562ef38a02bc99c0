"""Column functions: arithmetic, metrics, buckets, dates, distances, text."""
