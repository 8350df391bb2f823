"""Operators of a training-data pipeline: sharding, fingerprints, dedup, scans, scoring, packing and encoding.

Nothing outside this subpackage imports it. Every operator takes a frame with an
id and a text column, selects only the columns it needs (so further columns, also
with clashing names, never matter) and returns a new frame.
"""
