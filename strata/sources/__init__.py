"""Scans, the entity-profile stage, dataset IO."""
