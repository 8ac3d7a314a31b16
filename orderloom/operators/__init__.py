"""Row-level operators: first-copy selection, cleaning, constraints, enrichment, insert-if-absent."""
