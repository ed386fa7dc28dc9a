"""Writers of lake and serving tables."""
