"""Operators of a training-data pipeline (URL filters, token counts,
decontamination, language-model scoring, quality rules, secret scans,
near-duplicates, packing, binary token output, quality classifier).

Nothing else in the library imports this subpackage.
"""
