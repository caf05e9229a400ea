"""Reading and writing landed releases, their metadata and the derived tables."""
