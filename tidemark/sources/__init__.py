"""Reading topics and tables."""
