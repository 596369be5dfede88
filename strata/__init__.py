"""strata: layered (bronze → silver → gold) table pipelines on Spark DataFrames.

Operators live in ``strata.operators`` (columns, increments, joins, marts,
unions), sources and sinks in ``strata.sources``, table builders and the
launcher in ``strata.plans.layers``, the streaming ingest in
``strata.streaming``.
"""

__version__ = "0.1.0"
