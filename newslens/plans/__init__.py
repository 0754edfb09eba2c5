"""The library's jobs, composed from the operators."""
