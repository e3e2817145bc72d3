"""Readers, writers, staging, and the stand-in input tables."""
