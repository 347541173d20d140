"""Whole loads, and the queries registered for checking and timing."""
