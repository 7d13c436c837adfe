"""streaming of the edge-telemetry engine."""
