"""Training-data operators: scoring, decontamination, quality, near-duplicates,
secrets, personal data, url reputation, fingerprints, licences and mixing.

Nothing else in the library imports this subpackage.
"""
