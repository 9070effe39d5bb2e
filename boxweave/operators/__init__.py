"""DataFrame -> DataFrame operators, one module per curation stage."""
