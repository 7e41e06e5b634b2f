"""Larkspur: data studies on tables and text as Spark jobs."""
