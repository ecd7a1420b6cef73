"""Operators of a training-data pipeline: near duplicates, repeats, decontamination, personal data,
mixing, archives, token counts, language-model scores, licenses and quality rules.

Nothing else in the package imports this subpackage.
"""
