"""Recommenders over the contract tables and their evaluation."""
