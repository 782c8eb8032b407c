"""Report writers."""
