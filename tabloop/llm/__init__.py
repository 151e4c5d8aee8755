"""Operators of a training-data pipeline over documents, web pages and vectors, with their queries and SQL."""
