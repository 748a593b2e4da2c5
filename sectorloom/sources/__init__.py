"""Schemas, table stores and emulated inputs."""
