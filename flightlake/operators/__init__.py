"""Relational building blocks, each a ``DataFrame -> DataFrame`` function."""
