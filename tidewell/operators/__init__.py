"""Dataframe operators."""
