"""Column helpers: time, encodings, labels."""
