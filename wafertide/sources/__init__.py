"""Scans, wafer assembly, generators, state documents and sinks."""
