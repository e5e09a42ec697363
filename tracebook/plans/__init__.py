"""Whole plans: the disclosure pipeline, and the operators bound to the test tables."""
