"""Declared schemas, readers, writers and the stage-table hand-off."""
