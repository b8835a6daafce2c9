"""goldleaf.operators."""
