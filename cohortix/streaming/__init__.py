"""Scoring over Structured Streaming sources."""
