"""Segue: recommendation data work on ordered item lists, written as Spark jobs."""

__version__ = "0.1.0"
