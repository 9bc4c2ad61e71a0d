"""Column helpers: pure expressions, no session settings, no Python on the data path."""
