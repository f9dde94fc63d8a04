"""cvlens.operators."""
