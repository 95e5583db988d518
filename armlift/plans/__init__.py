"""Whole-platform plans built from the operators."""
