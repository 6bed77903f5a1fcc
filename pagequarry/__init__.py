"""Evidence analytics on Spark: pages, lines, tables, measurements and equipment records."""
