"""tidewater: raw JSON documents to tested analytics tables, on Spark.

Layers:
  sources/    scans of raw documents and request-like inputs
  functions/  Column -> Column building blocks (JSON paths, casts, casing, keys)
  operators/  DataFrame -> DataFrame steps (unnest, dedup, filters, quality checks)
  sinks/      envelopes, idempotent appends, materialisations
  plans/      the composed staging / mart transformations users call
  streaming/  the same plans on Structured Streaming
  fixtures    packs the flat driver tables into nested JSON shapes (Spark jobs)
  catalog/    registered queries + independent SQL oracles
"""

__version__ = "0.1.0"
