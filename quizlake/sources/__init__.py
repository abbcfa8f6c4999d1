"""Sources and sinks: item-bank payloads, Bronze CSV, Silver Parquet, staging views."""
