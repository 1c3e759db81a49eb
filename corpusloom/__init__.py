"""Spark jobs for building and quality-checking instruction-tuning corpora.

Every public function takes and returns DataFrames (or Columns), so jobs are
composed with ``df.transform``. See README.md for the map of modules.
"""
