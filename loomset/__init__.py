"""Supervised fine-tuning data preparation as Spark jobs.

Land a raw dataset, verify it, render its rows into one ``text`` column, drop
empty samples, take a leading subset, save with a manifest, and hand the result
to a trainer in a seeded order, split over ranks and batches.
"""
