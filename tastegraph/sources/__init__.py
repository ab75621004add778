"""Readers for the inputs the operators work on."""
