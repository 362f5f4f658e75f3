"""The engine's operators run on the driver tables, and the SQL that states the same results."""
