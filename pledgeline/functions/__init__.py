"""Column expressions: fiscal calendar, ratios and names. Built-in Spark functions only."""
