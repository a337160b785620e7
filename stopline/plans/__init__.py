"""Whole queries made from the operators."""
