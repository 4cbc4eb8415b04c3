"""Operators: event-table operators and gradient-boosted trees."""
