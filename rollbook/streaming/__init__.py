"""Register files as a file stream."""
