"""Readers and writers of the lake layers and of the landed feeds."""
