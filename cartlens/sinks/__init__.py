"""Where results are written to."""
