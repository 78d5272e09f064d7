"""Content quality scoring, topic discovery and recommendation as Spark jobs."""
