"""Column expressions: text to typed values, wall-clock time, request flags."""
