"""jobnest.streaming."""
