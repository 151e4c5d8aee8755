"""Multi-step jobs: training recipes, training, scoring, the improvement loop."""
