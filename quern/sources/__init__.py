"""Reading and writing record files."""
