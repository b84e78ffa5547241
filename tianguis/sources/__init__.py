"""Reading raw files, writing and reading the warehouse, and the stand-in for test tables."""
