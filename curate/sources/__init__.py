"""Where entries, registries and articles are read from and written to."""
