"""Column expressions over recommendation lists."""
