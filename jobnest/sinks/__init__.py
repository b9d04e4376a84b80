"""jobnest.sinks."""
