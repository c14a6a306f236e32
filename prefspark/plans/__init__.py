"""Whole jobs: sampling and first generation, the refinement rounds, the final products."""
