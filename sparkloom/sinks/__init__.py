"""Writers for files, managed tables and relational tables."""
