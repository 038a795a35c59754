"""Package operators of the engine."""
