"""The package's jobs on the given tables, each next to SQL that says the same."""
