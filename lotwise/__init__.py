"""Listing cleaning, name harmonising and price modelling on Spark."""
