"""Operators for training-data pipelines over ``documents``-shaped tables.

Nothing else in the library imports this package.  Shared rules:

* NULL text counts as empty text; extra columns never clash, since every operator
  selects what it needs under names of its own first.
* A word is a run of bytes other than space and ``\\t \\n \\v \\f \\r``.
* Intermediate tables go to the folder in ``spark.checkpoint.dir`` (``common.cut``),
  so that a lost executor costs a re-read, and no plan is evaluated twice.
"""
