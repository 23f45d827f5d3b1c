"""Batch jobs composed from sources and operators."""
