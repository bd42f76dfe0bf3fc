"""Composite jobs: from captured hits, measures, texts and records to documents and corpora."""
