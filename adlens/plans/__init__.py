"""Plans: model layers, the pipeline build, registered queries and oracles."""
