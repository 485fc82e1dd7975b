"""Whole loads made of steps: grants, ontology, publications and sample labels."""
