"""Keyed-state streaming."""
