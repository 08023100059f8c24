"""sinks package."""
