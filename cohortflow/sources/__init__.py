"""Reading files and tables, and writing them."""
