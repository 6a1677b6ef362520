"""Star-schema builders, relationship model, filter contexts, measures, time intelligence."""
