"""Operators of a training-data pipeline (quality, dedup, decontamination,
secrets, packing, token files, archives).  Nothing else in the library
imports this subpackage."""
