"""feedloom: change feeds of listings turned into enriched, versioned snapshots with Spark."""

__version__ = "0.1.0"
