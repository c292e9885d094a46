"""Streaming extensions."""
