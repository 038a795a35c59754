"""Spark-native analytics engine for long-term sensor waveforms."""
