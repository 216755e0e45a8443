"""Registered queries of the operators of this subpackage."""
