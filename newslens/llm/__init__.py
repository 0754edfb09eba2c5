"""Operations of a training-data pipeline: deduplication, filters, scoring, mixing, packing.

Nothing else in the library imports this subpackage.
"""
