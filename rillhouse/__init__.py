"""Layered operators of a live warehouse on PySpark.

Every operator takes and returns a Spark ``DataFrame``; where the semantics
allow it the same function accepts a batch and an unbounded one.
"""

__version__ = "0.1.0"
