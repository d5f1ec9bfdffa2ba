"""Composed jobs: materialised derived inputs (inputs), the ledger job
(ledger_job), the tabular pipeline end to end (training), and the registered
queries with their DuckDB oracles (ledger_queries, pipeline_queries)."""
