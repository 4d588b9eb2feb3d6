"""Readers, writers, typing of text results, and the retail view of the test tables."""
