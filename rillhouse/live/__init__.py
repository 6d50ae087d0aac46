"""Stateful processors and query helpers for Structured Streaming."""
