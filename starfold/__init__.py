"""Spark star-schema lakehouse: a flat vaccination feed to five dimensions and one fact."""
