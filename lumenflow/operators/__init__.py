"""Operators over movies, regions of interest, traces and pixel graphs."""
