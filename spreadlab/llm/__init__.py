"""Training-data operators (near-dedup, decontamination, mixing, toxicity, licences,
vector search, quality, token counts, privacy, HTML extraction).

Nothing else in the library imports this subpackage.
"""
