"""Column expressions: packed click times, codes and bins, calendar, error terms."""
