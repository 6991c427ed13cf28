"""The jobs: ingest, dimensions, facts, marts, document normalization, crawl frontier."""
