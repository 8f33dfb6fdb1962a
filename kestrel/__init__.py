"""kestrel: parameterised analytics on Spark DataFrames.

``kestrel.sources``    text-line parsers, CSV readers, test-table mappings
``kestrel.operators``  keyed aggregates and lookups, similarity, graph, ML
``kestrel.functions``  text and collection column functions
``kestrel.streaming``  windowed tag counts, batch and Structured Streaming
``kestrel.plans``      the registered queries and their SQL oracles
"""

__all__ = ["functions", "operators", "plans", "sources", "streaming", "session"]
