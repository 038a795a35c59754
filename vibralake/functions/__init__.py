"""Package functions of the engine."""
