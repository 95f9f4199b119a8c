"""Column-level helpers: time, numbers, text, display."""
