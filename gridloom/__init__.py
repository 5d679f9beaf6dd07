"""Spark jobs that turn crawled pages, listings and code files into a graded library of network endpoints."""
