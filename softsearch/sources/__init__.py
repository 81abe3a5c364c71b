"""Tables in and out: corpus, vector table, fitted model."""
