"""Batch jobs that curate datasets of vulnerable code, as functions from DataFrames to DataFrames."""
