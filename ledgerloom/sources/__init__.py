"""Readers for the feeds and writers for the exports."""
