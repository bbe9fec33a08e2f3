"""Writers and write policies."""
