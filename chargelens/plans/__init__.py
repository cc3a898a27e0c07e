"""Jobs that string operators together."""
