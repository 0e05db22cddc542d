"""Structured Streaming wrappers for the stateless operators.

The reference has no streams; these run the same per-row operators
(chunking, ids, hashed vectors, delimited lines) incrementally over a
folder of arriving Parquet files.  Sinks are idempotent (deterministic ids
+ anti-join on append), so a replayed micro-batch after a failure adds
nothing twice.
"""
