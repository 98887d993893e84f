"""Whole jobs, the versioned publish step and the registered queries."""
