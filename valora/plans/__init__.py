"""Composed plans: joined data set, feature stages, models, metrics, explanations, reports."""
