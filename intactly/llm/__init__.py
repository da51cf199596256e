"""Operators for training-data pipelines: ten text, vector and URL jobs and their queries."""
