"""Operators of a training-data pipeline: decontamination, search, encoding, archives, privacy,
near duplicates, toxicity, language, language-model scores, packing, spelling variants and
conversations.

Nothing else in the library imports this subpackage.
"""
