"""Topics, archives and the chat view over the provided tables."""
