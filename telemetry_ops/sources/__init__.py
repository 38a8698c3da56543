"""Readers, sinks and the telemetry tables derived from an event table."""
