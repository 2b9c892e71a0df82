"""Whole runs: bronze to silver to gold."""
