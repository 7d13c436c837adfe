"""sources of the edge-telemetry engine."""
