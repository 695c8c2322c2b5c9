"""Composed plans: registered queries, training, scoring, team analytics."""
