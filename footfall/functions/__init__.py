"""Column-level building blocks: dates, URL parts, rules and the normal distribution."""
