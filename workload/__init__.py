"""The operators run over the generated test tables, with their SQL counterparts."""
