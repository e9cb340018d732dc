"""Streaming forms of the polled alert and the lagged backup."""
