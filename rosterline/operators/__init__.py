"""Operators over the canonical tables: each takes DataFrames and returns a DataFrame.

Shared plan rules:

* facts are aggregated on the join key *before* they meet a dimension, so a key that holds a large
  share of the rows is folded map-side and the join sees one row per key;
* primary keys are counted with ``count``; ``count_distinct`` is kept for columns that do repeat;
* joins carry no broadcast hint: the optimizer measures a side before shipping it, and adaptive
  execution splits a hot key in row-level joins;
* sorted reports end with a unique column, which makes them repeatable and lets the range
  partitioner cut through a run of equal leading values.
"""
