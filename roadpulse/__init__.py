"""Spark jobs over geo-located, time-stamped road incident records."""
