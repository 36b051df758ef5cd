"""tastemesh: set-based recommendation operators on PySpark DataFrames.

Subpackages:
  sources    table scans, the test-data mapping, sinks and model persistence
  functions  column-expression helpers (strings, vectors, stop words)
  operators  preprocessing, indexing, collaborative, text, similarity,
             content, social and hybrid recommenders
  plans      the registry of named queries and their SQL oracles
  streaming  incremental ingest of review documents
"""

__version__ = "0.1.0"
