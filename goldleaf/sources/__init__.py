"""goldleaf.sources."""
