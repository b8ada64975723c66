"""Reading, checking and writing relations."""
