"""Sources: Kafka option builders, schema corpus, generator, driver-table builders."""
