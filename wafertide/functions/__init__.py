"""Column functions over waveforms."""
