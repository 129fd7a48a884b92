"""Operators for training-data pipelines, with their registered queries.

Nothing else in the library imports this subpackage."""
