"""DataFrame -> DataFrame operators over lifecycle events."""
