"""DataFrame operators over lanes."""
