"""Readers, writers and the subscriber view over the warehouse tables."""
