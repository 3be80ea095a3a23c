"""Layers on disk, web pages and nested records."""
