"""Tables and message topics, read and written."""
