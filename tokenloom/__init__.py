"""Spark jobs that prepare, pack, score and analyse text corpora."""
