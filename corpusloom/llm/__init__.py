"""Operators a training-data pipeline needs, one module each, and their queries."""
