"""Runnable jobs on tables of documents; each has a command line and a small config file beside it."""
