"""Quire: cleaning, star-schema modelling and reconciliation of legacy business tables on Spark."""
