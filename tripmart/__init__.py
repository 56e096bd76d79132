"""tripmart: a star-schema and dashboard toolkit for trip records on Spark.

Every public function takes and returns DataFrames. Readers and writers live
in ``sources`` and ``streaming``; the only other storage use is checkpoints
in the session's ``spark.checkpoint.dir`` (dense keys, dashboard
aggregates), which cut lineage where a result must be computed once.
"""

__all__ = ["session", "schemas", "fixtures"]
