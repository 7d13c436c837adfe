"""operators of the edge-telemetry engine."""
