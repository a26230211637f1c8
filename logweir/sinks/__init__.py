"""Tables the jobs write: alerts, rejects, cursors, registry, history."""
