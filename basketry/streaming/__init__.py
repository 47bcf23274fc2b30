"""Structured Streaming jobs: event contract, staging, incremental features."""
