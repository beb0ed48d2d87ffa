"""All registered queries with the SQL that must give the same rows."""

from quoteflow.plans import analytics, checks, jobs, pricing, requests, streams, traffic

_MODULES = (analytics, pricing, requests, jobs, traffic, checks, streams)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: text for module in _MODULES for name, text in module.ORACLE.items()}
