"""Reading and writing: messages, lake tables, files."""
