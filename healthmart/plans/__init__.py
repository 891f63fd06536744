"""Compositions: the report set over the star and the two pipelines."""
