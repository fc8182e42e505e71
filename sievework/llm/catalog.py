"""All queries of this subpackage, and the SQL of those that SQL can express."""

from . import classifier, decontaminate, divergence, html, langid, mixing, ppm, resampling, rules, sharding, simhash, substrings, warc

_MODULES = (classifier, decontaminate, divergence, html, langid, mixing, ppm, resampling, rules, sharding, simhash, substrings, warc)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
