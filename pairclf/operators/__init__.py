"""Operators on feature tables, tasks, models and words."""
