"""Column functions; all of them are native expressions."""
