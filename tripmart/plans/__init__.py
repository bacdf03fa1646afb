"""Logical plans of the silver, gold and report layers, and the refresh that stores them."""
