"""Forecasting plans and the registered queries."""
