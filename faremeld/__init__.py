"""Integration and comparison of price quotes from many sources, as Spark jobs."""
