"""Relational operators of a web-corpus pipeline."""
