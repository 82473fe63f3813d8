"""Holdfast: governed portfolio analytics expressed as Spark plans."""
