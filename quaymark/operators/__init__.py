"""Operators on DataFrames: decoding, applying, reconciling, dead letters, the cutover gate."""
