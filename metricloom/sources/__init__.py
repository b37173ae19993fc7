"""Reading, landing, publishing and generating the input tables."""
