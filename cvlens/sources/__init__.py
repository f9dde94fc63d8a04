"""cvlens.sources."""
