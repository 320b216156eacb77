"""End-to-end jobs built from the operators: items, export, stored tables, sync."""
