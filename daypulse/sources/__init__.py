"""Sources and sinks: feed registry, landing, reading."""
