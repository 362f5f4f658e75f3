"""The data flow: clean, star schema, waiting-time comparison, and the jobs that run them."""
