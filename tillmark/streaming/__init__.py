"""Event ingestion and event-time aggregates."""
