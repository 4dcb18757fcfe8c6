"""Column-level building blocks: parsing, scalar rules and aggregates."""
