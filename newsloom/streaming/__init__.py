"""The feed as a stream."""
