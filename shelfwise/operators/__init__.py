"""Table-to-table steps: clean, index, split, factorise, evaluate, rank, serve."""
