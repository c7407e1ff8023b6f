"""Readers for registers, snapshots, labels, predictions and caches."""
