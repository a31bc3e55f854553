"""spreadlab: a Spark-native engine for OHLCV bars and pair-trading research.

Sub-packages
  sources    reads, bar normalisation, surrogate bars, JSON inputs, sinks
  functions  column expressions (time, math, text)
  operators  windows, screening, features, dataset, model, scoring, report
  plans      job composition and the query catalog
  streaming  incremental ingest with Structured Streaming
"""
__version__ = "0.1.0"
