"""Column expressions. No DataFrame, no action, no clock in here."""
