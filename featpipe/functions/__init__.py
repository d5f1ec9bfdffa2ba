"""Column-expression helpers: address keys, epoch seconds, md5 hash buckets and
row fingerprints (keys), exact small-range distinct counts (distinct),
size-checked broadcast and bounded collection (frames), and the fixed-point
rounding shared with the SQL oracles (numeric)."""
