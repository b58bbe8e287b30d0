"""Landing folders, readers and a delivery generator."""
