"""Compositions: silver, gold, publishing and the batch run."""
