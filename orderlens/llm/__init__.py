"""Operators for large training-data pipelines (search, near duplicates,
line dedup, licences, token files, quality rules, URL filters, secrets,
packing, BPE). Nothing else in the library imports this subpackage."""
