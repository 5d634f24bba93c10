"""Writers. Each call is one job over its input."""
