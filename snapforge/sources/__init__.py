"""Sources and sinks: registry pages, sheets, reports and the run's state."""
