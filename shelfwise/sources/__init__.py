"""Readers and writers for every table the jobs exchange."""
