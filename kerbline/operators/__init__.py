"""Multi-row operators: dedup, zone enrichment, quality rules, ranking, spikes."""
