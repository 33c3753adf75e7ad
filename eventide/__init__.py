"""Eventide: clickstream lakehouse jobs as DataFrame-to-DataFrame functions on Spark."""
