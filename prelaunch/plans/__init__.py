"""Plans: fixture views, the feature build, the training pipeline, registry."""
