"""jobnest.plans."""
