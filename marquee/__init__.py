"""Batch lakehouse for film credits, written as DataFrame-to-DataFrame functions on Spark."""
