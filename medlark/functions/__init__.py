"""Shared column expressions and one-pass statistics used by the operators."""
