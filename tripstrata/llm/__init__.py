"""Training-data operators over ``documents``, ``pages`` and ``embeddings``.  Nothing outside imports this package."""
