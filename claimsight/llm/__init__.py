"""Training-data operators on Spark: language id, nearest neighbours, page text, fingerprints,
byte-level BPE, source mixing, token counts, near and substring dedup, quality scoring.

Nothing else in the library imports this subpackage.
"""
