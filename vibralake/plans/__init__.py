"""Package plans of the engine."""
