"""Tables the queries read, and connectors."""
