"""The jobs a user runs, put together from the operators."""
