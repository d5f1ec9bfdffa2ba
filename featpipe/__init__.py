"""featpipe: Spark DataFrame jobs for nested-ledger feature vectors and a
fit/apply tabular feature pipeline (statistics, validation, scoring, gating).

Sub-packages:
  sources    - readers and driver-table mappings (nested ledger, trips, CSV, splits)
  functions  - column-expression helpers (keys, epoch seconds, stable hashes)
  operators  - DataFrame -> DataFrame operators (ledger, profile, features, model, evaluate)
  plans      - composed end-to-end jobs
  streaming  - Structured Streaming scoring
"""

__version__ = "0.1.0"
