"""Whole transforms: cleansing, the star schema, the warehouse, a full run."""
