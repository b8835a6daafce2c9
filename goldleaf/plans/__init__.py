"""goldleaf.plans."""
