"""DataFrame -> DataFrame operators: ledger transfers, idle times, signatures
and labelled vectors; statistics, schema and validation; fit/apply
preprocessing; models; evaluation, gate and publishing."""
