"""Review curation on Spark: scan, split, clean, label, deduplicate, publish."""
