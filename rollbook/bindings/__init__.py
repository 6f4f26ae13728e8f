"""The operators bound to the test tables, and the same results in plain SQL."""
