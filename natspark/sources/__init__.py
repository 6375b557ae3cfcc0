"""Sources: log streams, dimension tables, range tables, fixtures."""
