"""Feeds in, tables out."""
