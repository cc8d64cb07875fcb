"""Open rail and tourism data on Spark: clean tables, streams and answers.

Every function takes and returns DataFrames or Columns.  The library makes no
session; the caller brings one (``trainlake.__main__`` is the only exception).
"""
