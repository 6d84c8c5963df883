"""Whole jobs: build the feature table, train and apply the model."""
