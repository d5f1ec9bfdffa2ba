"""Inputs: driver tables (tables), the nested ledger view and real ledger
tables (ledger), trips records (trips), CSV with a type rule (csv), and the
stable hash split plus examples storage partitioned by split (examples)."""
