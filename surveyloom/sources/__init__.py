"""Inputs and sinks."""
