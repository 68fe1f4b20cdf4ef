"""Sources: raw files, converted datasets, catalog tables, test-data adapter."""
