"""DataFrame -> DataFrame steps of the audit."""
