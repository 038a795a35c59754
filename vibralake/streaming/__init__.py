"""Package streaming of the engine."""
