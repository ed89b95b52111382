"""Sources: landed raw JSON, landing listings, tables, and the events-based fixtures."""
