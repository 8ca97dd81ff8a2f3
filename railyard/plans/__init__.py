"""Role projection of the test tables and the registry of runnable queries."""
