"""Readers and writers for annotation files, listings and reports."""
