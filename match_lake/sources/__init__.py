"""Landing folders and stored tables."""
