"""Whole tasks: compare, decide, repair, verify, log."""
