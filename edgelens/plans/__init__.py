"""plans of the edge-telemetry engine; importing it registers every query."""

from edgelens.plans import queries, exemptions  # noqa: F401
