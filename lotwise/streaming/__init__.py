"""Fitted steps on streams."""
