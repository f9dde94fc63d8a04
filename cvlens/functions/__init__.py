"""cvlens.functions."""
