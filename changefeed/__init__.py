"""Change-data pipeline as Spark jobs: capture, resolve, replay and read."""
