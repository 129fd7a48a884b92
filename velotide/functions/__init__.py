"""Column functions and rejection rules."""
