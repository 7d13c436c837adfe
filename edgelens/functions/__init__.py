"""functions of the edge-telemetry engine."""
