"""Package sources of the engine."""
