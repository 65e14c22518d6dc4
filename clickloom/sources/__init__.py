"""Tables and files: reading, creating, loading, exporting."""
