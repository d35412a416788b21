"""The registered queries: each operator and recipe run over the shared test tables."""
