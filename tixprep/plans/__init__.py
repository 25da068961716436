"""Composed flows: training-set preparation, rare-class set, profile report, table scoring."""
