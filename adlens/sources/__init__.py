"""Sources and sinks: JSONL files, tables, file inventory, driver adapter."""
