"""Behavioural and electrophysiology analytics as DataFrame -> DataFrame functions over whole cohorts."""
