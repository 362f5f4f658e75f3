"""Service-request analytics as Spark jobs: land, clean, gate, load, model, compare waiting times."""
