"""Collaborative filtering over rating data, as Spark jobs."""
