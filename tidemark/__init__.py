"""Tidemark: incremental loading and change merging, declared as Spark plans."""
