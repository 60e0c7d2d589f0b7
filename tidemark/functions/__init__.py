"""Column helpers. Every helper returns a Catalyst expression; none runs Python per row."""
