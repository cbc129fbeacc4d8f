"""Relational operators: each is ``DataFrame -> DataFrame``."""
