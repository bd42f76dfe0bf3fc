"""Writers for corpora, audits, run manifests and retrieval logs."""
