"""Landed responses, stored tables and sinks. Paths are always arguments."""
