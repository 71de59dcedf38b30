"""Complete questions, each a function of its input tables and parameters."""
