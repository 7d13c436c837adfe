"""edgelens: web-edge telemetry analytics as plain Spark DataFrame jobs."""
