"""Detectors and reference profiles."""
