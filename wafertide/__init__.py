"""Waveform process-control analytics on Spark."""
