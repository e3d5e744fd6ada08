"""storelens — app-store listings and reviews turned into a star schema and
dashboard metrics, written as Spark DataFrame plans.

Layout:
  sources/    raw readers (CSV, driver-table projections), schemas, catalog
  functions/  Column -> Column conversions (numbers, keys, dates, display text)
  operators/  reusable DataFrame operators (dedup, top-k, sample, histogram,
              value counts, count expansion, quality checks)
  plans/      the datasets: ingest, staging, marts, dashboard metrics, pipeline
  sinks/      table / CSV writers and model materialisation
  streaming/  the ingest steps on Structured Streaming file sources
"""

__version__ = "0.1.0"
