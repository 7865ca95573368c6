"""Meal-feedback warehouse, marts and choice-model data sets as Spark jobs."""
