"""rowtide: change-data capture as Spark DataFrames.

Snapshots and per-shard change logs go in; typed UPSERT / UPDATE / DELETE /
TRUNCATE records and folded current tables come out, with resumable state.
Ids in docstrings (S1, C5, W4, D1 ...) are those of the operator inventory.
"""

__version__ = "0.1.0"
