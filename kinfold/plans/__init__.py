"""Query catalogue: named queries over the table directories and their SQL."""
