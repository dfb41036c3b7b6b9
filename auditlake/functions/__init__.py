"""Column-level building blocks: times, identifiers, layout and payloads."""
