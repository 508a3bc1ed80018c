"""Dimensions, facts, marts, measures and analyses composed of the operators."""
