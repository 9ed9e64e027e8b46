"""DataFrame -> DataFrame operators (envelope, registry, validation, buffer, persistence)."""
