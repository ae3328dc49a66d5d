"""Where reviews come from and where records go."""
