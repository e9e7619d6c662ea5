"""The batch entry, deterministic fixtures over the driver tables, and the registered queries with their
oracle SQL."""
