"""Serving a stream of requests."""
