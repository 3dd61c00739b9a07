"""The jobs: corpus, store, curated sets, profile."""
