"""Column functions: masks, text, time, types."""
