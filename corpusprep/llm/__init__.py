"""Operators of a training-data pipeline, their registered queries and the queries' SQL."""
