"""DataFrame operators over pages, items, robots rules and runs."""
