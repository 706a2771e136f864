"""Stylometric text analytics on Spark."""
