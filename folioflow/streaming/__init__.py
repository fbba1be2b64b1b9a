"""Resumable incremental runs."""
