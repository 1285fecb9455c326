"""Readers of captured files and databases, and report and state writers."""
