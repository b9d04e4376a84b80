"""jobnest.sources."""
