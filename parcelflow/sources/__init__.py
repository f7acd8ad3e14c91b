"""Sources: raw feeds (landing, registry), the label seed, the test binding."""
