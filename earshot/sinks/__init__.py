"""Writing results."""
