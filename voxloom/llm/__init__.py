"""Training-data operators: deduplication, scoring, search, scanning and packing on Spark.

Nothing outside this subpackage imports it; ``voxloom.llm.queries`` lists its registered queries.
"""
