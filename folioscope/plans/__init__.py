"""Registered queries (callables of a session and a data directory) and their SQL twins."""
