"""Builders of the typed views, entities and marts, and ``build`` that makes any of them from raw tables."""
