"""siftline: feed curation (parse, validate, dedup, filter, score, budget,
report) as Spark DataFrame and Structured Streaming operators.

Every operator is a function ``DataFrame -> DataFrame`` keyed by
``sweep_id`` so that one new sweep, a replay of many sweeps and a stream run
through the same code.
"""

__version__ = "0.1.0"
