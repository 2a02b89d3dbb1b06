"""Corpus-to-network analytics expressed as Spark plans."""
