"""Time-bar analytics over tick, quote and instrument feeds, written as Spark DataFrame programs."""
