"""Sources and sinks: files, message logs, request tables."""
