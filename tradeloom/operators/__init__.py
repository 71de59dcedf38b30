"""Reusable DataFrame-to-DataFrame steps the plans are made of."""
