"""goldleaf.functions."""
