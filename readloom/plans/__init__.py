"""Compositions of operators: whole-workflow plans and cross-step reports."""
