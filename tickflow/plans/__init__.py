"""Ways of laying out ordered work over many tasks, and composed plans."""
