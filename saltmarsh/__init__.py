"""saltmarsh: environmental and public-health analytics as plain Spark DataFrame jobs."""
