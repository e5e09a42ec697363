"""Disclosure analytics as Spark DataFrame functions.

Every operator takes DataFrames plus parameters (keys, order columns, thresholds)
and returns a lazy DataFrame, so the same code runs on disclosure records and on
any other tables that have the same shape.
"""
