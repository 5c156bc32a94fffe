"""Operators of a training-data pipeline (deduplication, packing, filters,
extraction).  Nothing else in the library imports this subpackage."""
