"""Relational operators over node tables, document trees, metrics and upload states."""
