"""goldleaf.streaming."""
