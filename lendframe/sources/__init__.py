"""Readers, writers, the feature store and the model registry."""
