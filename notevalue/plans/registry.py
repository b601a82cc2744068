"""All registered queries."""

from notevalue.plans import curation, enrichment, modelling, retrieval, scanning, scoring

MODULES = (curation, scoring, modelling, retrieval, enrichment, scanning)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: text.strip() for module in MODULES for name, text in module.ORACLES.items()}
