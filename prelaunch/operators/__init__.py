"""DataFrame -> DataFrame operators: cohort, profile, tags, text, encode, evaluate, models."""
