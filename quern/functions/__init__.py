"""Column functions for text, HTML, JSON replies and scores."""
