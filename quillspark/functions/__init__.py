"""See the module names."""
