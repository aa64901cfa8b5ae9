"""Where events, counts and comments are read from."""
