"""Reading and writing tables, and the run configuration."""
