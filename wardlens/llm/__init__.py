"""Training-data operators: extraction, dedup, classification, scans, tokenising, formatting and
sharding. Nothing else in the library imports this subpackage."""
