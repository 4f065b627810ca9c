"""Training-data operators: deduplication, decontamination, tokenising, scanning and archives.

Nothing else in the library imports this subpackage.
"""
