"""Plans: session settings, stored intermediates and whole pipelines."""
