"""Fitted models applied to streaming DataFrames."""
