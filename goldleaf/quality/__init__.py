"""goldleaf.quality."""
