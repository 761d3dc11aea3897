"""Training-data operators: deduplication, quality, tokenisation, decontamination, URL filters and scoring.

Nothing else in the library imports this subpackage.
"""
