"""Whole flows made of the operators: prepare, answer, analyse."""
