"""Structured Streaming: incremental, resumable scoring of arriving item files."""
