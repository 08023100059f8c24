"""Reusable physical-plan shapes: size-checked broadcast, top-k per group, tile pairs."""
