"""jobmart: job-market analytics as Spark DataFrame jobs.

* ``jobmart.functions`` — classifiers as Column expressions;
* ``jobmart.sources``   — table reads, landed pages, versioned / log tables, the test-data adapter;
* ``jobmart.operators`` — lifecycle, pull audit, enrichment, gold, housing, analyses, maintenance;
* ``jobmart.plans``     — the query registry, its DuckDB oracle, and the writing job wrappers;
* ``jobmart.streaming`` — the landed-pages ingest stream.
"""
