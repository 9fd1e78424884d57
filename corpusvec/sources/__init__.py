"""Reading source files and published indexes."""
