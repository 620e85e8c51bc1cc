"""Landing folders as streams."""
