"""Landed feed files to typed rows.

Each module has a reader (files -> raw text with its path) and a row builder (raw
text -> typed columns), so that the builder also runs on text that is already in a
table. Builders return malformed records too, marked by a ``valid`` column; see
``hazardbook.operators.quality.screen``.
"""
