"""Table readers, derived test views and file sources."""
