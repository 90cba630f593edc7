"""The alert plan on a stream."""
