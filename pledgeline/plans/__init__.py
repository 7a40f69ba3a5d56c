"""Composition of operators, and the join and numbering shapes that survive hot keys."""
