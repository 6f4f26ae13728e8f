"""Register files, release pages and versioned tables."""
