"""Query plans: inputs derived from the tables, the query registry, jobs."""
