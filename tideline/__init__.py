"""Tideline: batch and streaming dataflow operators as plain DataFrame functions."""
